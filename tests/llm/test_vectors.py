import math

import numpy as np
import pytest

from monthglass.llm.metric_join import choose_pivots, near_vectors, unit


def brute(rows, limit=0.95):
    good = lambda v: v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
    at = {k: np.array(v, float) for k, (_, v) in enumerate(rows) if good(v)}
    near = {k: set() for k in range(len(rows))}
    for i, x in at.items():
        for j, y in at.items():
            if i < j and len(x) == len(y) and unit(x[None])[0] @ unit(y[None])[0] >= limit:
                near[i].add(j)
                near[j].add(i)
    out, seen = [], {}
    for k in near:
        if k not in seen:
            group, todo = {k}, [k]
            while todo:
                for x in near[todo.pop()] - group:
                    group.add(x)
                    todo.append(x)
            ids = [rows[x][0] for x in group if rows[x][0] is not None]
            seen |= dict.fromkeys(group, min(ids, default=None))
    for k, (i, _) in enumerate(rows):
        out.append((i, len(near[k]), seen[k], i == seen[k]))
    return sorted(out, key=str)


def cluster(r, n, size, dims, spread):
    centers = r.normal(size=(n, dims))
    return [c / np.linalg.norm(c) + spread * r.normal(size=dims) for c in centers for _ in range(size)]


def got(df, **kw):
    return sorted((tuple(x) for x in near_vectors(df, **kw).collect()), key=str)


@pytest.mark.parametrize("kw", [{}, {"cell": 5, "block": 4, "portion": 3}, {"cell": 40, "pivots": 2, "block": 10, "portion": 1000}])
@pytest.mark.parametrize(("dims", "spread"), [(2, 0.2), (8, 0.05), (24, 0.03)])
def test_equals_brute_force(spark, dims, spread, kw):
    r = np.random.default_rng(dims)
    vectors = cluster(r, 12, 8, dims, spread) + [7.5 * v for v in cluster(r, 1, 70, dims, 0.01)] + list(r.normal(size=(60, dims)))
    rows = [(int(i), [float(np.float32(x)) for x in vectors[k]]) for k, i in enumerate(r.permutation(len(vectors)))]
    rows += [(1000 + i, rows[i % 5][1]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    assert got(df, **kw) == brute(rows)


def test_odd_vectors(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, [1.0, 0.0]),
        (8, [1e300, 1e299]), (9, [1e-300, 0.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.01]), (None, [-1.0, 0.0]), (12, [0.0, 1.0]), (12, [0.0, -1.0]),
        (13, [-0.0, 2.0]), (14, [0.0, 2.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "'n' as n", "0 as vec", "2 as cell")
    assert got(df) == brute(rows)
    assert near_vectors(df.limit(0)).count() == 0


def test_pivots_keep_their_distance(spark):
    r = np.random.default_rng(1)
    rows = [([float(x) for x in v],) for v in cluster(r, 1, 300, 6, 0.001) + list(r.normal(size=(50, 6)))]
    found = choose_pivots(spark.createDataFrame(rows, "vec array<double>"), 0.3, cell=2)[6]
    assert 3 < len(found) <= 51


def test_a_crowd_is_not_compared(spark):
    """A cell of near copies has one core: none of its members visits another block."""
    from monthglass.llm import metric_join as m

    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(cluster(r, 1, 400, 16, 0.002))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {x[1] for x in got(df, block=10, portion=10)} == {399}
    seen = []
    m_parts = m._parts
    try:
        m._parts = lambda *a: seen.append(m_parts(*a)) or seen[-1]
        near_vectors(df, block=10, portion=10)
    finally:
        m._parts = m_parts
    assert seen[0].where("visitor").count() == 0 and seen[0].count() == 400
