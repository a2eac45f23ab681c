"""Metrics, drift and quantiles against independent numpy computations."""

from datetime import datetime as dt
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthglass.operators import classify as cl
from monthglass.operators import drift as dr
from monthglass.operators import quantiles as qt
from monthglass.operators.running import value_splits

rng = np.random.default_rng(5)


def np_auc(y, p):
    pos, neg = p[y == 1], p[y == 0]
    if not len(pos) or not len(neg):
        return None
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


def np_ap(y, p):
    if not y.sum():
        return 0.0
    total, before = 0.0, 0.0
    for t in sorted(set(p), reverse=True):
        hit = p >= t
        recall = y[hit].sum() / y.sum()
        total += (recall - before) * y[hit].mean()
        before = recall
    return total


@pytest.fixture(scope="module")
def scored(spark):
    rows = []
    for i in range(1200):
        g = "hot" if i % 3 else f"g{i % 9}"
        p = round(float(rng.random()), 2)
        y = int(rng.random() < 0.2 + 0.5 * p)
        rows.append((g, y, int(p >= 0.5), p))
    rows += [("one", 1, 1, 0.3), ("one", 1, 0, 0.2), ("none", 0, 1, 0.4), ("none", 0, 0, 0.4)]
    rows += [("unscored", 0, 1, None), ("unscored", 1, 1, 0.4)]
    return rows, spark.createDataFrame(rows, "g string, y int, yhat int, p double")


@pytest.mark.parametrize("cuts", [None, [], [0.5], [i / 100 for i in range(1, 100)]])
def test_performance(scored, cuts):
    rows, df = scored
    got = {r.g: r for r in cl.performance(df, "y", "yhat", "p", ["g"], splits=cuts, keep_counts=True).collect()}
    assert set(got) == {r[0] for r in rows}
    for g, r in got.items():
        y, yhat, p = (np.array([x[i] for x in rows if x[0] == g], dtype=float) for i in (1, 2, 3))
        tp = ((y == 1) & (yhat == 1)).sum()
        assert r.accuracy == pytest.approx((y == yhat).mean())
        assert r.precision == pytest.approx(tp / yhat.sum() if yhat.sum() else 0)
        assert r.recall == pytest.approx(tp / y.sum() if y.sum() else 0)
        if g == "unscored":
            assert (r.roc_auc, r.pr_auc) == (None, None)
            continue
        assert r.roc_auc == pytest.approx(np_auc(y, p))
        assert r.pr_auc == pytest.approx(np_ap(y, p))


def test_performance_over_time_uses_first_date(spark):
    rows = [(dt(2023, 1, 5), 1, 1, 0.9), (dt(2023, 1, 3), 0, 0, 0.1), (dt(2023, 2, 1), 1, 0, 0.2)]
    df = spark.createDataFrame(rows, "d timestamp, y int, yhat int, p double")
    got = {r.snapshot_date: r for r in cl.performance_over_time(df, "d", "y", "yhat", "p").collect()}
    assert set(got) == {dt(2023, 1, 3), dt(2023, 2, 1)}
    assert got[dt(2023, 1, 3)].roc_auc == 1.0 and got[dt(2023, 2, 1)].roc_auc is None
    # 2023-01-03 is a Tuesday: the week starts on Monday the 2nd.
    assert cl.performance_over_time(df, "d", "y", "yhat", "p", "week").count() == 2


def test_best_model(spark):
    df = spark.createDataFrame([("b", 0.8), ("a", 0.8), ("c", None)], "model_name string, roc_auc double")
    assert cl.best_model(df).first().model_name == "a"


def np_psi(ref, cur):
    ref, cur = ref[~np.isnan(ref)], cur[~np.isnan(cur)]
    edges = np.histogram_bin_edges(ref, 10)
    a, b = np.histogram(ref, edges)[0], np.histogram(cur, edges)[0]
    p, q = (a + 1) / (len(ref) + 10), (b + 1) / (len(cur) + 10)
    return float(((q - p) * np.log(q / p)).sum())


def np_ks(ref, cur):
    ref, cur = np.sort(ref[~np.isnan(ref)]), np.sort(cur[~np.isnan(cur)])
    at = np.concatenate([ref, cur])
    gap = np.searchsorted(ref, at, "right") / len(ref) - np.searchsorted(cur, at, "right") / len(cur)
    return float(np.abs(gap).max())


@pytest.fixture(scope="module")
def monthly(spark):
    rows = []
    start = dt(2023, 1, 1)
    for i in range(2000):
        day = int(rng.integers(0, 330))
        # One month holds a third of the rows, one value a third of a feature.
        d = start + timedelta(days=170 if i % 3 == 0 else day)
        a = float(rng.normal(day / 100, 1))
        b = 0.0 if i % 3 == 1 else float(rng.integers(0, 30))
        c = None if rng.random() < 0.3 else float(rng.exponential(2))
        rows.append((d, a, b, c, 7.0, None if d < dt(2023, 5, 1) else 1.0, float(rng.random()), int(rng.random() < 0.3)))
    df = spark.createDataFrame(
        rows, "d timestamp, a double, b double, c double, flat double, late double, prediction_proba_1 double, label int"
    )
    return rows, df


@pytest.mark.parametrize("cuts", [0, 1, 40])
def test_stability(monthly, cuts):
    rows, df = monthly
    splits = {c: sorted({float(x) for x in np.linspace(-2, 30, cuts)}) for c in ("a", "b", "c", "flat", "late")} if cuts else None
    got = {r.snapshot_date: r for r in dr.stability_over_time(df, "d", splits=splits).collect()}
    first = min(r[0] for r in rows)
    limit = first.replace(month=first.month + 3)
    ref = [r for r in rows if r[0] <= limit]
    assert len(got) == len({r[0].month for r in rows})
    for when, g in got.items():
        cur = [r for r in rows if r[0].month == when.month]
        assert (g.reference_sample_count, g.current_sample_count) == (len(ref), len(cur))
        want_psi, want_ks = {}, {}
        for i, c in ((1, "a"), (2, "b"), (3, "c"), (4, "flat")):
            x, z = (np.array([r[i] for r in part], dtype=float) for part in (ref, cur))
            want_psi[c], want_ks[c] = np_psi(x, z), np_ks(x, z)
        # "late" has no reference value, so it is not scored.
        assert g.psi_scores == pytest.approx(want_psi)
        assert g.ks_scores == pytest.approx(want_ks)
        assert g.mean_psi == pytest.approx(np.mean(list(want_psi.values())))
        assert g.max_ks == pytest.approx(max(want_ks.values()))
        assert g.prediction_drift == pytest.approx(abs(np.mean([r[6] for r in cur]) - np.mean([r[6] for r in ref])))
        assert g.label_drift == pytest.approx(abs(np.mean([r[7] for r in cur]) - np.mean([r[7] for r in ref])))


def test_psi_and_ks_share_their_range_counts(spark, monthly, tmp_path):
    monthly[1].write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    out = dr.stability_over_time(stored, "d", ["a", "b"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    # Drift of the means, the shared ranges, the values.
    assert plan.count("FileScan") == 3


def test_no_feature_gives_null_scores(monthly):
    _, df = monthly
    row = dr.stability_over_time(df, "d", ["late"]).first()
    assert (row.mean_psi, row.max_ks, row.psi_scores) == (None, None, None)


def test_values_outside_the_reference_range_count_in_n(spark):
    rows = [(1, None, float(x)) for x in range(10)] + [(0, "w", 99.0), (0, "w", 0.0)]
    df = spark.createDataFrame(rows, "r int, w string, x double")
    marked = dr.mark(df, F.col("r") == 1, F.col("w"))
    ref = dr.fit_reference(marked.where("r = 1"), ["x"])
    got = dr.psi(marked, ref).first().psi
    assert got == pytest.approx(np_psi(np.arange(10.0), np.array([99.0, 0.0])))


def test_nan_is_missing_and_infinity_is_a_value(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, float(x)) for x in range(10)] + [(1, None, nan), (0, "w", 3.0), (0, "w", nan), (0, "w", inf), (0, "w", 5.0)]
    df = spark.createDataFrame(rows, "r int, w string, x double")
    marked = dr.mark(df, F.col("r") == 1, F.col("w"))
    ref = dr.fit_reference(marked.where("r = 1"), ["x"])
    cur = np.array([3.0, inf, 5.0])
    assert dr.psi(marked, ref).first().psi == pytest.approx(np_psi(np.arange(10.0), cur))
    assert dr.ks(marked, ref).first().ks == pytest.approx(np_ks(np.arange(10.0), cur))
    assert qt.exact_quantiles(df, ["x"], [0.5])["x"] == pytest.approx([5.0])
    scores = spark.createDataFrame([(1, 1, nan), (0, 0, 0.1)], "y int, yhat int, p double")
    assert cl.performance(scores, "y", "yhat", "p").first().roc_auc is None


def test_drift_report(monthly):
    rows, df = monthly
    named = df.withColumn("kind", F.when(F.col("b") > 10, "x").when(F.col("b") > 3, "y")).drop("late")
    at = F.col("d") <= dr.median_date(df, "d")
    median = sorted(r[0] for r in rows)[len(rows) // 2 - 1 : len(rows) // 2 + 1]
    ref = [r for r in rows if r[0] <= median[0] + (median[1] - median[0]) / 2]
    cur = [r for r in rows if r not in ref]
    got = {r.feature: r for r in dr.drift_report(named, at, ["a", "b"], ["kind"]).collect()}
    x, z = np.array([r[1] for r in ref]), np.array([r[1] for r in cur])
    assert got["a"].psi == pytest.approx(np_psi(x, z)) and got["a"].ks == pytest.approx(np_ks(x, z))

    def kind(r):
        return "x" if r[2] > 10 else "y" if r[2] > 3 else None

    n = {k: (sum(kind(r) == k for r in ref), sum(kind(r) == k for r in cur)) for k in ("x", "y", None)}
    p = {k: (v[0] + 1) / (len(ref) + 3) for k, v in n.items()}
    q = {k: (v[1] + 1) / (len(cur) + 3) for k, v in n.items()}
    assert got["kind"].psi == pytest.approx(sum((q[k] - p[k]) * np.log(q[k] / p[k]) for k in n))
    assert got["a"].drifted == (got["a"].psi >= 0.1)
    missing = {r.column_name: r for r in dr.missing_values_report(named, at, ["c", "kind"]).collect()}
    assert missing["c"].missing_reference == sum(r[3] is None for r in ref)
    shift = dr.target_shift(df, at, "label").first().shift
    assert shift == pytest.approx(abs(np.mean([r[7] for r in ref]) - np.mean([r[7] for r in cur])))


def test_alerts(spark):
    perf = spark.createDataFrame(
        [(dt(2023, 1, 1), 0.8), (dt(2023, 2, 1), 0.76), (dt(2023, 3, 1), 0.7)], "snapshot_date timestamp, f1 double"
    )
    stab = spark.createDataFrame(
        [(dt(2023, 1, 1), 0.01, 0.05), (dt(2023, 2, 1), 0.1, 0.25), (dt(2023, 3, 1), 0.1, 0.1)],
        "snapshot_date timestamp, mean_psi double, max_psi double",
    )
    got = [(r.psi_alert, r.f1_alert, r.retrain) for r in dr.drift_alerts(perf, stab).orderBy("snapshot_date").collect()]
    assert got == [("ok", False, False), ("critical", False, True), ("warning", True, True)]


@pytest.fixture(scope="module")
def numbers(spark):
    rows = []
    for i in range(700):
        hot = 5.0 if i % 3 == 0 else float(rng.normal(0, 100))
        rows.append((hot, None if i % 4 else float(rng.exponential(3)), None, int(rng.integers(0, 4))))
    return rows, spark.createDataFrame(rows, "a double, b double, empty double, k int")


@pytest.mark.parametrize("bracket", [qt.BRACKET, 0.1, 0.2])
def test_exact_quantiles(numbers, monkeypatch, bracket):
    """Small limits force ranges to be cut again, also around the very frequent value."""
    rows, df = numbers
    monkeypatch.setattr(qt, "BRACKET", bracket)
    probs = [0.0, 0.01, 0.25, 0.5, 0.7, 0.95, 1.0]
    found = qt.order_statistics(df, ["a", "b", "empty", "k"], probs)
    got = {c: [qt.interpolate(x) for x in xs] for c, xs in found.items()}
    assert got["empty"] == [None] * 7
    for i, c in ((0, "a"), (1, "b"), (3, "k")):
        want = np.quantile([r[i] for r in rows if r[i] is not None], probs)
        assert got[c] == pytest.approx(list(want))


def test_quantiles_of_one_and_two_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    assert qt.exact_quantiles(df, ["x"], [0.0, 0.5, 0.95])["x"] == pytest.approx([1.0, 2.0, 2.9])
    assert qt.exact_quantiles(df.where("x = 1"), ["x"], [0.01, 0.5])["x"] == [1.0, 1.0]
    caps, medians = qt.fit_caps_and_medians(df, ["x"], ["x"])
    assert medians["x"] == pytest.approx(qt.exact_quantiles(qt.apply_caps(df, caps), ["x"], [0.5])["x"][0])


def test_caps_then_medians(numbers):
    _, df = numbers
    caps, medians = qt.fit_caps_and_medians(df, ["a", "b", "empty"], ["a", "b", "empty", "k"])
    capped = qt.apply_caps(df, caps)
    again = qt.exact_quantiles(capped, ["a", "b", "k"], [0.5])
    assert {c: medians[c] for c in again} == pytest.approx({c: v[0] for c, v in again.items()})
    filled = qt.apply_fill(capped, medians)
    assert filled.where("b is null").count() == 0
    assert filled.where("empty is null").count() == df.count()


def test_other_methods(numbers):
    rows, df = numbers
    b = np.array([r[1] for r in rows if r[1] is not None])
    q1, q3 = np.quantile(b, [0.25, 0.75])
    assert qt.fit_caps(df, ["b"], "iqr")["b"] == pytest.approx((q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)))
    assert qt.fit_caps(df, ["b"], "zscore")["b"] == pytest.approx((b.mean() - 3 * b.std(ddof=1), b.mean() + 3 * b.std(ddof=1)))
    assert qt.fit_fill(df, ["b"], "mean")["b"] == pytest.approx(b.mean())
    assert qt.fit_scale(df, ["b"])["b"] == pytest.approx((b.mean(), b.std()))
    assert qt.fit_scale(df, ["b"], "robust")["b"] == pytest.approx((np.median(b), q3 - q1))
    with pytest.raises(ValueError):
        qt.fit_caps(df, ["b"], "other")
    flat = qt.apply_scale(df.selectExpr("1.0D as x"), {"x": (1.0, 0.0)})
    assert flat.first().x == 0.0
    assert qt.sketch_quantiles(df, ["b"], [0.5], 0.0)["b"][0] in set(b)


def test_splits_are_few(numbers):
    _, df = numbers
    assert all(len(v) <= 16 for v in value_splits(df, ["a", "b", "k"], 16).values())
