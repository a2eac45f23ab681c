"""Targets against a loop; taken words against targets; reruns; edges."""

import pytest
from pyspark.sql import functions as F

from monthglass.llm import mixing


def loop_targets(sizes, weights=(3, 1, 2), total=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, left = {}, set(order), total * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] > most * sizes[s]}
        if not full:
            return target | {s: level * w[s] for s in free}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [{"a": 100, "b": 900, "c": 50, "é": 10, None: 4000}, {"a": 5}, {"a": 0, "b": 10}, {"a": 1, "b": 1, "c": 1}, {None: 0}, {"x": 10**9, "y": 1, "z": 3}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(loop_targets(sizes))


def test_takes_near_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    monkeypatch.setattr(mixing, "FAN", 4)
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 37).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.lit(1).alias("size"),
    )
    rows = mixing.mix_sources(docs).collect()
    again = mixing.mix_sources(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.copies) for r in rows) == sorted((r.doc_id, r.copies) for r in again)
    assert len(rows) == 3000 and all(0 <= r.taken <= 2 * r.size and r.size == r.doc_id % 37 for r in rows)
    taken, target = {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    assert len(taken) == 7 and all(abs(taken[s] - target[s]) <= 37 for s in taken)


def test_expectation(spark):
    """Over many seeds a document's copies average its fraction."""
    import numpy as np

    ids = np.arange(40)
    parts = np.full(40, 0.3)
    ends = np.array([mixing.pivot(ids * 1000003, (1.0 + ids % 5), parts, s) for s in range(3000)])
    assert ((ends > 0) & (ends < 1)).sum(axis=1).max() <= 1
    assert abs(ends.mean(axis=0) - 0.3).max() < 0.05
    assert np.allclose(ends @ (1.0 + ids % 5), 0.3 * (1.0 + ids % 5).sum())


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_sources(none).count() == 0
    rows = [(None, "a b", None), (1, None, "s"), (1, None, "s"), (2, "", "s"), (3, "é  ü\tö \n", "s"), (None, "a b", None)]
    got = mixing.mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(r.size for r in got) == [0, 0, 0, 2, 2, 3] and all(r.taken <= 2 * r.size for r in got)
