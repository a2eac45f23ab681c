"""Registered queries: two-sample tests of features, categories and targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import curves as cv
from ..operators import drift as dr
from ..operators import drift_store as ds
from ..operators import quantile_store as qs
from ..operators import shift_tests as st
from ..session import staging_path
from .queries_metrics import (
    _HALVES,
    _MARKED,
    _STABILITY_COLUMNS,
    _STABILITY_SQL,
    DATE,
    FEATURES,
    PROB,
    _half,
    _ks_sql,
    _long_sql,
    _marked,
    _orders,
    _psi_sql,
    _round,
)
from .registry import query
from .views import with_views

CATEGORIES = ["priority", "status", "label"]
TARGETS = ["label", "prediction"]


def _tail_sql(freedom: str, x: str) -> str:
    """Upper tail of the chi-square distribution: one minus the power series of the incomplete gamma function."""
    a, h = f"({freedom}) / 2.0::DOUBLE", f"({x}) / 2.0::DOUBLE"
    term = f"exp(({a}) * ln({h}) - {h} + k * ln({h}) - lgamma({a} + k + 1))"
    series = f"list_sum(list_transform(range(0, 1500), lambda k: {term}))"
    return f"CASE WHEN {x} <= 0 THEN 1.0 WHEN {x} > 1200 THEN 0.0 ELSE greatest(0.0, 1 - {series}) END"


def _ks_tail_sql(d: str, n: str, m: str) -> str:
    at = f"sqrt({n}::DOUBLE * {m} / ({n} + {m})) * {d}"
    series = f"2 * list_sum(list_transform(range(1, 200), lambda k: CASE WHEN k % 2 = 1 THEN 1 ELSE -1 END * exp(-2 * k * k * pow({at}, 2))))"
    return f"CASE WHEN {at} < 0.1 THEN 1.0 ELSE least(1.0, greatest(0.0, {series})) END"


_LONG = _long_sql(_HALVES, FEATURES)
_JS = "(CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2"

_CURVES = f"""(
    SELECT feature, max(nr) AS n_reference, max(nc) AS n_current, max(gap) AS ks, sum(gap * coalesce(nxt - v, 0)) AS area FROM (
      SELECT *, abs(sum(r) OVER o / nr - sum(c) OVER o / nc) AS gap, lead(v) OVER o AS nxt FROM (
        SELECT *, sum(r) OVER f AS nr, sum(c) OVER f AS nc FROM (
          SELECT feature, v, count(*) FILTER (ref)::DOUBLE AS r, count(*) FILTER (NOT ref)::DOUBLE AS c FROM {_LONG} GROUP BY 1, 2)
        WINDOW f AS (PARTITION BY feature))
      WINDOW o AS (PARTITION BY feature ORDER BY v))
    GROUP BY feature)"""

_BINS = f"""(
    SELECT l.feature, CASE WHEN v BETWEEN lo AND hi THEN least(9, (
             SELECT max(i) FROM range(0, 10) AS t(i) WHERE i * ((hi - lo) / 10) + lo <= v)) ELSE -1 END AS i,
           count(*) FILTER (ref)::DOUBLE AS r, count(*) FILTER (NOT ref)::DOUBLE AS c
    FROM {_LONG} AS l JOIN (SELECT feature, min(v) AS lo, max(v) AS hi FROM {_LONG} WHERE ref GROUP BY 1) AS e ON e.feature = l.feature
    GROUP BY 1, 2)"""


def _js_sql(bins: str) -> str:
    return f"""(SELECT feature, sqrt(greatest(sum({_JS}), 0)) AS js FROM (
      SELECT feature, r / sum(r) OVER f AS p, c / sum(c) OVER f AS q FROM {bins} WINDOW f AS (PARTITION BY feature)) GROUP BY feature)"""


_NUMERIC = f"""(
    SELECT c.feature, 'numeric' AS kind, n_reference, n_current, ks, area / greatest(s.sd, 0.001) AS wasserstein, js, p.psi
    FROM {_CURVES} AS c JOIN {_js_sql(_BINS)} AS j ON j.feature = c.feature JOIN {_psi_sql(_HALVES, FEATURES)} AS p ON p.feature = c.feature
    JOIN (SELECT feature, stddev_pop(v) AS sd FROM {_LONG} WHERE ref GROUP BY 1) AS s ON s.feature = c.feature)"""


def _category_counts(columns: list[str]) -> str:
    parts = [
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, count(*) FILTER (ref)::DOUBLE AS r, count(*) FILTER (NOT ref)::DOUBLE AS c "
        f"FROM {_HALVES} GROUP BY 2"
        for c in columns
    ]
    return f"({' UNION ALL '.join(parts)})"


def _category_sql(columns: list[str]) -> str:
    counts = _category_counts(columns)
    return f"""(
    SELECT x.*, js, CASE WHEN categories = 2 THEN 'binary' ELSE 'categorical' END AS kind,
      (qc - qr) / sqrt(share * (1 - share) * (1 / n_reference + 1 / n_current)) AS z FROM (
      SELECT feature, max(nr) AS n_reference, max(nc) AS n_current, count(*) AS categories,
        sum(pow(r - (r + c) * nr / (nr + nc), 2) / ((r + c) * nr / (nr + nc)) + pow(c - (r + c) * nc / (nr + nc), 2) / ((r + c) * nc / (nr + nc))) AS chi,
        sum((q - p) * ln(q / p)) AS psi, last(r / nr ORDER BY category NULLS FIRST) AS qr, last(c / nc ORDER BY category NULLS FIRST) AS qc,
        last((r + c) / (nr + nc) ORDER BY category NULLS FIRST) AS share
      FROM (SELECT *, (r + 1) / (nr + k) AS p, (c + 1) / (nc + k) AS q FROM (
        SELECT *, sum(r) OVER f AS nr, sum(c) OVER f AS nc, count(*) OVER f AS k FROM {counts} WINDOW f AS (PARTITION BY feature)))
      GROUP BY feature) AS x JOIN {_js_sql(counts)} AS j ON j.feature = x.feature)"""


def _tests_sql(columns: list[str], numeric: bool = True) -> str:
    row = "SELECT feature, kind, '{}' AS test, round({}, 6) AS statistic, round({}, 6) AS p_value, n_reference::BIGINT AS n_reference, n_current::BIGINT AS n_current FROM {}"
    none, by = "CAST(NULL AS DOUBLE)", _category_sql(columns)
    parts = [
        row.format("jensen_shannon", "js", none, by),
        row.format("psi", "psi", none, by),
        row.format("chi_square", "chi", _tail_sql("categories - 1", "chi"), by),
        row.format("z", "z", _tail_sql("1", "z * z"), by) + " WHERE categories = 2",
    ]
    if numeric:
        parts += [
            row.format("wasserstein", "wasserstein", none, _NUMERIC),
            row.format("jensen_shannon", "js", none, _NUMERIC),
            row.format("psi", "psi", none, _NUMERIC),
            row.format("ks", "ks", _ks_tail_sql("ks", "n_reference", "n_current"), _NUMERIC),
        ]
    return " UNION ALL ".join(parts)


def _decided_sql(chosen, columns: list[str], numeric: bool = True) -> str:
    limits = {**st.DISTANCES, **st.P_VALUES}
    pick = " OR ".join(f"(kind = '{k}' AND test = '{t}')" for k, t in chosen.items())
    limit = "CASE test " + " ".join(f"WHEN '{t}' THEN {x}" for t, x in limits.items()) + " END"
    by_p = ", ".join(f"'{t}'" for t in st.P_VALUES)
    return f"""SELECT *, CAST({limit} AS DOUBLE) AS threshold, CASE WHEN test IN ({by_p}) THEN p_value < {limit} ELSE statistic >= {limit} END AS drifted
    FROM ({_tests_sql(columns, numeric)}) WHERE {pick}"""


def _tests(spark, sf_dir, features=FEATURES, categories=CATEGORIES):
    rows = _orders(spark, sf_dir)
    return st.all_tests(rows, _half(rows), features, categories)


def _rounded(df):
    return _round(df, ["statistic", "p_value"])


@query("drift_test_table", with_views("scored_orders", body=_tests_sql(CATEGORIES)))
def drift_test_table(spark, sf_dir):
    return _rounded(_tests(spark, sf_dir))


@query("drift_tests", with_views("scored_orders", body=_decided_sql(st.TESTS, CATEGORIES)))
def drift_tests(spark, sf_dir):
    return _rounded(st.decide(_tests(spark, sf_dir)))


@query("drift_tests_p_values", with_views("scored_orders", body=_decided_sql(st.P_VALUE_TESTS, CATEGORIES)))
def drift_tests_p_values(spark, sf_dir):
    return _rounded(st.decide(_tests(spark, sf_dir), st.P_VALUE_TESTS))


@query("target_tests", with_views("scored_orders", body=_decided_sql(st.P_VALUE_TESTS, TARGETS, numeric=False)))
def target_tests(spark, sf_dir):
    return _rounded(st.decide(_tests(spark, sf_dir, [], TARGETS), st.P_VALUE_TESTS))


_SIZES = f"""(SELECT w, feature, n::BIGINT AS n_current, nr::BIGINT AS n_reference FROM (
      SELECT w, feature, count(*) AS n FROM {_long_sql(_MARKED, FEATURES)} GROUP BY 1, 2)
    JOIN (SELECT feature, count(*) AS nr FROM {_long_sql(_MARKED, FEATURES)} WHERE ref GROUP BY 1) USING (feature))"""


@query(
    "ks_test",
    with_views(
        "scored_orders",
        body=f"""
    SELECT w AS window, feature, round(ks, 6) AS ks, n_reference, n_current, round({_ks_tail_sql("ks", "n_reference", "n_current")}, 6) AS p_value
    FROM {_ks_sql(_MARKED, FEATURES).replace(", 6) AS ks", ", 15) AS ks")} JOIN {_SIZES} USING (w, feature)""",
    ),
)
def ks_test(spark, sf_dir):
    """The distance of every month to the reference, with the p-value of each."""
    found = dr.ks_samples(*_marked(spark, sf_dir))
    p = st.ks_p_value(F.col("ks"), F.col("n_reference"), F.col("n_current"))
    return _round(found.withColumn("p_value", p), ["ks", "p_value"])


@query("stability_by_month_added", with_views("scored_orders", body=_STABILITY_SQL))
def stability_by_month_added(spark, sf_dir):
    """A store that was given all months but the last year, then that year, then one month once more."""
    rows = _orders(spark, sf_dir)
    first, last = (r.strftime("%Y-%m") for r in rows.agg(F.min(DATE), F.max(DATE)).first())
    store = ds.start(spark, staging_path(spark, "drift-store"), rows, DATE, FEATURES, PROB, "label")
    before = f"{int(last[:4]) - 1}-{last[5:]}"
    ds.add(store, rows, first, before)
    ds.add(store, rows, before, last)
    ds.add(store, rows, last)
    return _round(ds.stability(store), _STABILITY_COLUMNS, 4).drop("psi_scores", "ks_scores")


# A point is a corner if the steepest way on is less steep than the least steep way up to it.
_CURVE = {
    "c": f"""SELECT priority, {PROB} AS threshold, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n FROM scored_orders GROUP BY 1, 2""",
    "k": """SELECT priority, threshold, CAST(sum(p) OVER o AS BIGINT) AS tp, CAST(sum(n) OVER o AS BIGINT) AS fp,
        CAST(sum(p) OVER g AS BIGINT) AS positives, CAST(sum(n) OVER g AS BIGINT) AS negatives
        FROM c WINDOW o AS (PARTITION BY priority ORDER BY threshold DESC), g AS (PARTITION BY priority)""",
    "z": "SELECT priority, 2::DOUBLE AS threshold, 0 AS tp, 0 AS fp FROM k GROUP BY 1 UNION ALL SELECT priority, threshold, tp, fp FROM k",
    "before": """SELECT a.priority, a.threshold, min(CASE WHEN a.fp = b.fp THEN 'inf'::DOUBLE ELSE (a.tp - b.tp)::DOUBLE / (a.fp - b.fp) END) AS up
        FROM k AS a JOIN z AS b ON b.priority = a.priority AND b.threshold > a.threshold GROUP BY 1, 2""",
    "behind": """SELECT a.priority, a.threshold, max(CASE WHEN a.fp = b.fp THEN 'inf'::DOUBLE ELSE (b.tp - a.tp)::DOUBLE / (b.fp - a.fp) END) AS up
        FROM k AS a JOIN k AS b ON b.priority = a.priority AND b.threshold < a.threshold GROUP BY 1, 2""",
    "m": f"""SELECT k.*, coalesce(behind.up < before.up, TRUE) AS corner, floor((tp::DOUBLE / positives + fp::DOUBLE / negatives) / 2 * {cv.STEPS}) AS step
        FROM k JOIN before USING (priority, threshold) LEFT JOIN behind USING (priority, threshold)""",
    "f": "SELECT *, row_number() OVER (PARTITION BY priority, step ORDER BY threshold DESC) AS place FROM m",
}
_POINTS = """SELECT priority, threshold, tp, fp, positives, negatives, round(tp::DOUBLE / positives, 6) AS tpr, round(fp::DOUBLE / negatives, 6) AS fpr,
    round(tp::DOUBLE / (tp + fp), 6) AS precision, corner FROM f WHERE corner OR place = 1"""


def _points(spark, sf_dir):
    return cv.curve_points(_orders(spark, sf_dir), "label", PROB, ["priority"])


@query("roc_curve_points", with_views("scored_orders", more=_CURVE, body=_POINTS))
def roc_curve_points(spark, sf_dir):
    return _round(_points(spark, sf_dir), ["tpr", "fpr", "precision"])


@query("roc_hull", with_views("scored_orders", more=_CURVE, body="SELECT priority, threshold, tp, fp FROM m WHERE corner"))
def roc_hull(spark, sf_dir):
    return _points(spark, sf_dir).where("corner").select("priority", "threshold", "tp", "fp")


_QUANTILES = {"q01": 0.01, "q50": 0.5, "q95": 0.95}


@query(
    "quantiles_stored",
    with_views(
        "scored_orders",
        body=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, " + ", ".join(f"round(quantile_cont({c}, {q}), 6) AS {n}" for n, q in _QUANTILES.items()) + " FROM scored_orders"
            for c in FEATURES
        ),
    ),
)
def quantiles_stored(spark, sf_dir):
    """Cut on the first two years, then given all months in two parts, and one of them once more."""
    rows = _orders(spark, sf_dir)
    first, last = (r.strftime("%Y-%m") for r in rows.agg(F.min(DATE), F.max(DATE)).first())
    early = rows.where(F.year(DATE) <= int(first[:4]) + 1)
    store = qs.start(spark, staging_path(spark, "quantile-store"), early, FEATURES, ranges=32)
    middle = f"{int(first[:4]) + 3}-06"
    qs.add(store, rows, DATE, first, middle)
    qs.add(store, rows, DATE, middle, last)
    qs.add(store, rows, DATE, last)
    found = qs.stored_quantiles(store, rows, list(_QUANTILES.values()))
    made = spark.createDataFrame([(c, *[float(x) for x in v]) for c, v in found.items()], "feature string, " + ", ".join(f"{n} double" for n in _QUANTILES))
    return _round(made, list(_QUANTILES))
