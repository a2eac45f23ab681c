"""The pipeline, stage by stage, against brute force on a small table."""

import collections
import os
import random
import re

import pytest
from test_leaks import fitting
from test_leaks import words as alnum_words
from test_minhash import brute as near_brute
from test_windows import brute as line_brute

import corpus_pipeline
from monthglass.llm.leaks import allowed
from monthglass.llm.mixing import word_count
from pyspark.sql import functions as F

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def good(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    windows = collections.Counter(zip(w, w[1:], w[2:]))
    there = {i + k for i in range(n - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    chars = sum(map(len, w))
    shouted = sum(len(re.findall("[A-Z]", x)) >= 2 and not re.search("[a-z]", x) for x in w)
    return not (
        n < 50
        or 100 * len(there) > 50 * n
        or 100 * len(re.findall(r"[#*$%&|<>]", text)) > 20 * n
        or 2 * chars < 5 * n
        or chars > 14 * n
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or 100 * shouted > 50 * n
        or 100 * len(set(w)) < 20 * n
    )


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    r = random.Random(11)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 8)))
    items = [(k, " ".join(word() for _ in range(r.randint(15, 40)))) for k in range(20)]
    shared = "\n".join(" ".join(word() for _ in range(9)) for _ in range(5))
    rows = []
    for d in range(0, 260, 2):
        body = [" ".join(word() for _ in range(r.randint(8, 20))) for _ in range(r.randint(4, 12))]
        kind = d % 14
        if kind == 2:
            body = [" ".join(x + "***" for x in line.split()) for line in body]
        elif kind == 4:
            body[1:1] = shared.split("\n")
        elif kind == 6:
            body[2] = items[d % 20][1]
        elif kind == 8:
            body = [line.upper() for line in body]
        rows.append((d, "\n".join(body), "en", f"s{d % 3}" if d % 5 else None, 0))
        if kind in (0, 4, 6):
            t = rows[-1][1].split(" ")
            for _ in range(max(1, len(t) // 60)):
                t[r.randrange(len(t))] = word()
            rows.append((d + 1, " ".join(t), "en", "s1", 0))
    rows += [(1001, None, None, None, None), (1002, "", "en", "s0", 0), (1003, "few words", "en", "s0", 0)]
    rows.append((1004, next(t for _, t, *_ in rows if good(t) and t.count("\n") > 3), "en", "s0", 0))
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(a, b, c, s, len(b) if b is not None else None) for a, b, c, s, _ in rows], SCHEMA).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, items


def test_stages(spark, tables, tmp_path):
    folder, rows, items = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "mixing"]

    def step(name, docs):
        out = stages[name](spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        assert out.columns == COLUMNS + ["copy"] * (name == "mixing")
        return out, {x.doc_id: x for x in out.collect()}

    docs, got = step("quality_rules", docs)
    state = {a: b for a, b, *_ in rows if good(b)}
    assert {d: x.text for d, x in got.items()} == state and 40 < len(state) < len(rows) - 40

    docs, got = step("line_dedup", docs)
    # A document that lost all its lines goes.
    cut = {d: t for d, (t, n, gone) in line_brute(list(state.items())).items() if not 0 < n == gone}
    assert {d: x.text for d, x in got.items()} == cut and cut != state and len(cut) < len(state)
    assert all(x.n_chars == len(x.text) for x in got.values())
    state = cut

    docs, got = step("near_dedup", docs)
    found = near_brute(list(state.items()), 5, 80)
    kept = {d: t for d, t in state.items() if found[d][1] == d}
    assert {d: x.text for d, x in got.items()} == kept and len(kept) < len(state)
    state = kept

    docs, got = step("decontamination", docs)
    bench = [alnum_words(t) for _, t in items]
    leaks = lambda t: any(fitting(i, alnum_words(t)) <= allowed(len(i), 0.2) for i in bench)
    clean = {d: t for d, t in state.items() if not leaks(t)}
    assert {d: x.text for d, x in got.items()} == clean and len(clean) < len(state)

    mixed, _ = step("mixing", docs)
    size = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in clean.items()}
    source = {a: s for a, _, _, s, _ in rows}
    names = sorted({source[d] for d in clean if source[d]}) + [None]
    taken, most = collections.Counter(), collections.Counter()
    for x in mixed.collect():
        assert x.text == clean[x.doc_id]
        taken[x.source] += size[x.doc_id]
        most[x.doc_id] = max(most[x.doc_id], x.copy)
    assert mixed.count() == sum(most.values()) and max(most.values()) <= 2
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= len(names) * max(size.values())


def test_run_agrees_with_its_stages(spark, tables):
    folder, _, _ = tables
    one, two = ([(x.doc_id, x.text, x.copy) for x in corpus_pipeline.run(spark, folder).collect()] for _ in range(2))
    assert sorted(one) == sorted(two) and one


def test_used_stages_are_removed(spark, tables, monkeypatch):
    from monthglass import session

    folder, _, _ = tables
    made, path = [], session.staging_path
    for module in (session, corpus_pipeline):
        monkeypatch.setattr(module, "staging_path", lambda s, name: made.append(path(s, name)) or made[-1])
    out = corpus_pipeline.run(spark, folder)
    there = [p for p in made if os.path.exists(p.removeprefix("file:"))]
    last = made.index(next(p for p in made if "/decontamination-" in p))
    # The input of the last stage, and what that stage itself has stored.
    assert set(there) <= set(made[last:]) and made[last] in there and len(made) > len(there) + 10
    assert out.count() > 0


def test_edges(spark, tables):
    """Empty tables, repeated rows, null ids and extra columns go through every stage."""
    folder, rows, _ = tables
    text = next(t for _, t, *_ in rows if good(t))
    schema = SCHEMA + ", copy string, _id int, _made string"
    same = (7, text, "en", "s", len(text), "c", 1, "x")
    given = [same, same, (None, text, "en", "s", len(text), "c", 1, "x"), (None, None, None, None, None, None, None, None)]
    # Of the copies one keeps its lines; the row without id loses them all and goes.
    for rows_, left in (([], set()), (given, {(7, text)})):
        docs = spark.createDataFrame(rows_, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, folder).collect(), schema) if name != "mixing" else stage(spark, docs, folder)
        assert {(x.doc_id, x.text) for x in docs.collect()} == left


def test_word_count(spark):
    texts = [None, "", "  ", "a", " a  b\tc\n", "é\x0bü\x0c x\r\ny", "a\xa0b"]
    got = [x.n for x in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", word_count(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
