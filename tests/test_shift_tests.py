"""Two-sample tests against numpy, exact sums and the standard library."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthglass.operators import drift as dr
from monthglass.operators import shift_tests as st

rng = np.random.default_rng(11)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize("z", [0.0, 0.3, 1.0, 1.96, 2.99 * math.sqrt(2), 3.01 * math.sqrt(2), 6.0, 12.0])
def test_normal_tail(spark, z):
    assert value(spark, st.normal_p_value(F.lit(z))) == pytest.approx(math.erfc(z / math.sqrt(2)), rel=1e-4, abs=1e-15)


@pytest.mark.parametrize("freedom", [1, 2, 3, 4, 7, 20, 101, 1000, 100_000])
@pytest.mark.parametrize("at", [0.1, 0.9, 1.0, 1.1, 3.0])
def test_chi_square_tail(spark, freedom, at):
    x = freedom * at
    found = value(spark, st.chi_square_p_value(F.lit(x), F.lit(freedom)))
    # Integral of the density by the midpoint rule, in 400,000 steps over all that counts.
    low, high = x, max(x, freedom) + 60 * math.sqrt(2 * freedom) + 80
    t = low + (np.arange(400_000) + 0.5) * (high - low) / 400_000
    density = np.exp((freedom / 2 - 1) * np.log(t) - t / 2 - freedom / 2 * math.log(2) - math.lgamma(freedom / 2))
    assert found == pytest.approx(density.sum() * (high - low) / 400_000, rel=2e-3, abs=1e-9)


def test_chi_square_edges(spark):
    assert value(spark, st.chi_square_p_value(F.lit(0.0), F.lit(3))) == 1.0
    assert value(spark, st.chi_square_p_value(F.lit(5.0), F.lit(0))) is None


def test_ks_tail(spark):
    p = lambda d: value(spark, st.ks_p_value(F.lit(d), F.lit(1000), F.lit(1000)))
    # Critical values of the limiting distribution: 1.2238 at 0.1, 1.3581 at 0.05, 1.6276 at 0.01.
    for at, want in ((1.22385, 0.1), (1.35810, 0.05), (1.62762, 0.01)):
        assert p(at / math.sqrt(500)) == pytest.approx(want, abs=1e-5)
    assert p(0.0) == 1.0 and p(1.0) < 1e-200


def samples(kind, n, m):
    if kind == "ties":
        return rng.integers(0, 6, n) / 2, rng.integers(1, 9, m) / 2
    if kind == "apart":
        return rng.normal(size=n), 50 + rng.normal(size=m)
    return rng.normal(size=n), 1.3 * rng.normal(size=m) + 0.4


def as_frame(spark, columns):
    """columns: name -> (reference values, current values), all of equal lengths per side."""
    rows = []
    for side in (0, 1):
        n = max(len(v[side]) for v in columns.values())
        for i in range(n):
            cells = [v[side][i] if i < len(v[side]) else None for v in columns.values()]
            rows.append((side == 0, *[None if x is None else float(x) if not isinstance(x, str) else x for x in cells]))
    kinds = ["string" if isinstance(next(iter([*v[0], *v[1]])), str) else "double" for v in columns.values()]
    return spark.createDataFrame(rows, "ref boolean, " + ", ".join(f"{c} {k}" for c, k in zip(columns, kinds)))


def cdf(x, at):
    return np.searchsorted(np.sort(x), at, "right") / len(x)


@pytest.mark.parametrize("ranges", ["3", "40"])
def test_numbers(spark, ranges):
    columns = {k: samples(k, 500, 340) for k in ("plain", "ties", "apart")}
    columns["few"] = (np.array([1.0, 2.0]), np.array([5.0]))
    df = as_frame(spark, columns)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        found = {(r.feature, r.test): r for r in st.all_tests(df, F.col("ref"), list(columns), []).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 4 * len(columns)
    for name, (r, c) in columns.items():
        at = np.unique(np.concatenate([r, c]))
        gap = np.abs(cdf(r, at) - cdf(c, at))
        area = (gap[:-1] * np.diff(at)).sum()
        got = found[name, "wasserstein"]
        assert got.statistic == pytest.approx(area / max(np.std(r), 0.001)) and got.p_value is None
        assert (got.n_reference, got.n_current, got.kind) == (len(r), len(c), "numeric")
        assert found[name, "ks"].statistic == pytest.approx(gap.max())
        edges = np.linspace(r.min(), r.max(), 11)
        share = lambda x: np.append(np.histogram(x, edges)[0], ((x < edges[0]) | (x > edges[-1])).sum()) / len(x)  # noqa: B023, E731
        p, q = share(r), share(c)
        part = lambda a: np.where(a > 0, a * np.log(np.where(a > 0, 2 * a / (p + q), 1)), 0).sum() / 2  # noqa: B023, E731
        assert found[name, "jensen_shannon"].statistic == pytest.approx(math.sqrt(max(0, part(p) + part(q))), abs=1e-9)
    assert found["plain", "ks"].p_value < 1e-3 and found["few", "ks"].p_value > 0.2


def test_categories(spark):
    columns = {"one": (["a"] * 9, ["a"] * 7), "two": (["x"] * 60 + ["y"] * 40, ["x"] * 30 + ["y"] * 50), "new": (["a"] * 9, ["b"] * 7)}
    columns["more"] = (list(rng.choice(list("pqrs"), 300)), list(rng.choice(list("pqrstu"), 200)))
    columns = {k: ([str(x) for x in r], [str(x) for x in c]) for k, (r, c) in columns.items()}
    found = {}
    for name, pair in columns.items():
        df = as_frame(spark, {name: pair})
        found |= {(r.feature, r.test): r for r in st.all_tests(df, F.col("ref"), [], [name]).collect()}
    for name, (r, c) in columns.items():
        names = sorted({*r, *c})
        table = np.array([[x.count(k) for k in names] for x in (r, c)], float)
        expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
        chi = ((table - expected) ** 2 / expected).sum()
        assert found[name, "chi_square"].statistic == pytest.approx(chi, abs=1e-9)
        assert ((name, "z") in found) == (len(names) == 2)
        if len(names) == 2:
            assert found[name, "z"].statistic ** 2 == pytest.approx(chi)
            assert found[name, "z"].p_value == pytest.approx(found[name, "chi_square"].p_value)
    assert found["two", "z"].statistic > 0 and found["one", "chi_square"].p_value is None
    assert found["new", "jensen_shannon"].statistic == pytest.approx(math.sqrt(math.log(2)))


def test_decisions(spark):
    columns = {"same": (np.arange(100.0), np.arange(100.0)), "moved": (np.arange(100.0), 40 + np.arange(100.0))}
    df = as_frame(spark, columns).withColumn("side", F.when(F.col("ref"), "a").otherwise("b"))
    tests = st.all_tests(df, F.col("ref"), ["same", "moved"], ["side"])
    for chosen in (st.TESTS, st.P_VALUE_TESTS):
        got = {r.feature: r for r in st.decide(tests, chosen).collect()}
        assert {k: r.drifted for k, r in got.items()} == {"same": False, "moved": True, "side": True}
        assert got["same"].test == chosen["numeric"] and got["side"].test == chosen["binary"]
    assert not any(r.drifted for r in st.decide(tests, distances={"wasserstein": 9, "jensen_shannon": 9}).collect())
    with pytest.raises(ValueError, match="no threshold"):
        st.decide(tests, {"numeric": "t"})


def test_columns_without_values(spark):
    df = spark.createDataFrame([(True, None, 1.0, "a"), (False, 2.0, None, None), (False, 3.0, float("nan"), None)], "ref boolean, x double, y double, c string")
    got = {(r.feature, r.test) for r in st.all_tests(df, F.col("ref")).collect()}
    assert {f for f, _ in got} == {"c"}
    assert st.all_tests(df.limit(0), F.col("ref"), ["x"], ["c"]).count() == 0
    with pytest.raises(ValueError, match="no column"):
        st.all_tests(df, F.col("ref"), ["x"], [])


def test_ks_sizes(spark):
    df = as_frame(spark, {"v": (np.array([1.0, 2.0, 2.0]), np.array([2.0, 9.0]))})
    marked = dr.mark(df, F.col("ref"), F.when(~F.col("ref"), F.lit("w")))
    r = dr.ks_samples(marked, dr.fit_reference(df.where("ref"), ["v"])).first()
    assert (r.n_reference, r.n_current) == (3, 2) and r.ks == pytest.approx(0.5)
