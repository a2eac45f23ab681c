"""The two classifiers: gradients, held-out accuracy, and edges."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from monthglass.llm import passages, toxic

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def auc(score, label):
    rank = np.argsort(np.argsort(score))
    yes = label == 1
    return (rank[yes].sum() - yes.sum() * (yes.sum() - 1) / 2) / (yes.sum() * (~yes).sum())


def test_attention_gradient():
    draw = np.random.default_rng(0)
    begin = np.array([0, 3, 4, 9])
    x, label = draw.normal(size=(9, passages.WIDTH)), np.array([1.0, 0.0, 1.0])
    weight = np.ones(3)
    shapes = {"V": (passages.WIDTH, 4), "b": (4,), "T": (4, 3), "G": (4, 3), "u": (3,), "o": (4,), "c": (1,)}
    w = {k: draw.normal(size=v) * 0.3 for k, v in shapes.items()}
    loss = lambda: -np.mean(label * np.log(passages._forward(w, x, begin)["y"]) + (1 - label) * np.log(1 - passages._forward(w, x, begin)["y"]))
    grad = passages._gradient(w, x, begin, label, weight)
    for k in w:
        at = tuple(0 for _ in shapes[k])
        w[k][at] += 1e-5
        up = loss()
        w[k][at] -= 2e-5
        down = loss()
        w[k][at] += 1e-5
        assert grad[k][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_passages_cover_whole_texts():
    texts = pa.array(["a " * 64, "b " * 65, "", None, "c", "d " * 1000])
    x, begin = passages.encode(texts, 0, 6)
    assert np.diff(begin).tolist() == [1, 2, 1, 1, 1, 16] and not x[begin[2] : begin[4]].any()
    again, at = passages.encode(texts, 1, 3)
    assert np.allclose(again[at[0] : at[1]], x[begin[1] : begin[2]])


def test_quality_on_held_out_documents(spark, tables):
    docs, labels = tables
    model = passages.train(docs, labels)
    got = {r.doc_id: r for r in passages.score(docs, model).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and 0 <= r.top_passage < r.n_passages for r in got.values())
    held = [r for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    flags = {r.doc_id: r.h for r in docs.select("doc_id", passages.held_out("doc_id").alias("h")).collect()}
    assert all(flags[d] == (zlib.crc32(str(d).encode()) % 5 == 0) for d in flags)
    score, label = np.array([got[r.doc_id].score for r in held]), np.array([r.quality for r in held])
    assert auc(score, label) > 0.93 and ((score >= 0.3) == label).mean() > 0.93


def test_held_out_labels_change_nothing(spark, tables):
    docs, labels = tables
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(passages.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = passages.train(docs, labels), passages.train(docs, turned)
    assert all(np.array_equal(a.w[k], b.w[k]) for k in a.w)


def test_toxicity_on_unseen_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    side = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    chain = toxic.train(docs, labels.where(~side))
    assert chain.names == ["junk", "toxic"] and [len(m.earlier) for m in chain.models] == [0, 1]
    got = {r.doc_id: r for r in toxic.score(docs, chain).collect()}
    unseen = labels.where(side).collect()
    marked = np.array([got[r.doc_id].is_toxic for r in unseen])
    label = np.array([r.toxic == 1 for r in unseen])
    assert (marked & label).sum() >= 0.8 * label.sum() and (marked & ~label).sum() <= 0.005 * len(label)
    assert all(0 <= r.p_toxic <= 1 and 0 <= r.p_junk <= 1 for r in got.values())


@pytest.mark.parametrize("labelled", [[], [(1, 1, 0)], [(1, None, None)], [(1, 0, 1), (2, 1, 0), (1, 1, 0), (None, 1, 1)]])
def test_edges(spark, labelled):
    docs = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "y"), (None, "", None)], "doc_id long, text string, score string")
    labels = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    assert len(passages.score(docs, passages.train(docs, labels)).collect()) == 4
    assert len(toxic.score(docs, toxic.train(docs, labels)).collect()) == 4
    none = docs.limit(0)
    assert passages.score(none, passages.train(none, labels)).count() == 0 and toxic.score(none, toxic.train(none, labels)).count() == 0


def long_texts(spark, n=40, words=100_000):
    """Texts of which half hold one bad passage, at another place in each, among very many plain and mostly different words."""
    draw = np.random.default_rng(4)
    rows = []
    for i in range(n):
        body = [f"w{x}" for x in draw.integers(0, 60_000, words if i < 6 else 400)]
        if i % 2:
            at = int(draw.integers(0, len(body) - 70))
            body[at : at + 70] = [f"BAD{x}!!!" for x in draw.integers(0, 5, 70)]
        rows.append((i, " ".join(body), i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(i, 1 - bad, bad) for i, _, bad in rows], "doc_id long, quality int, toxic int")
    return rows, docs, labels


def test_training_takes_whole_texts(spark, monkeypatch):
    rows, docs, labels = long_texts(spark)
    seen = {}
    fit, chain = passages.fit, toxic.fit_chain
    monkeypatch.setattr(passages, "fit", lambda x, begin, y: seen.update(passages=np.diff(begin)) or fit(x, begin, y))
    monkeypatch.setattr(toxic, "fit_chain", lambda w, begin, y: seen.update(slots=np.diff(begin)) or chain(w, begin, y))
    model, trained = passages.train(docs, labels), toxic.train(docs, labels)
    learned = [t for i, t, _ in rows if zlib.crc32(str(i).encode()) % 5]
    assert sorted(seen["passages"]) == sorted(-(-len(t.split()) // passages.PASSAGE) for t in learned)
    want = [np.diff(toxic.slots(pa.array([t]), 0, 1)[1])[0] for _, t, _ in rows]
    assert sorted(seen["slots"]) == sorted(want) and max(want) > 40_000
    # A slot number of the bad words is known, wherever it lies.
    bad = {int(x) for k in range(5) for x in toxic.slots(pa.array([f"bad{k}"]), 0, 1)[0]}
    assert all(trained.models[1].slots[x] > 0 for x in bad)
    scored = {r.doc_id: r for r in passages.score(docs, model).collect()}
    first = [i for i, _, _ in rows if i < 6]
    assert min(scored[i].score for i in first if i % 2 == 0) > max(scored[i].score for i in first if i % 2)


def test_sample_is_bounded_by_bytes(spark):
    from monthglass.llm.samples import whole_bags

    rows = [(h, bytes(n)) for h, n in ((5, 10), (1, 40), (3, 500), (2, 30), (4, 20))]
    df = spark.createDataFrame(rows, "h long, bag binary")
    pick = lambda largest, total: sorted(r.h for r in whole_bags(df, largest, total))
    assert pick(1000, 1000) == [1, 2, 3, 4, 5] and pick(100, 1000) == [1, 2, 4, 5]
    assert pick(100, 70) == [1, 2] and pick(100, 95) == [1, 2, 4] and pick(5, 100) == [] and pick(100, 39) == []
