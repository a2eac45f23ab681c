"""Registered queries: classification quality, drift, alerts and chart tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import charts
from ..operators import classify as cl
from ..operators import drift as dr
from ..operators.learn import temporal_split as split_rows
from .registry import query
from .views import view, with_views

DATE, PROB = "feature_snapshot_date", "prediction_proba_1"
FEATURES = ["amount", "customer_group", "part_amount"]
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]
RATES = ["actual_default_rate", "predicted_default_rate"]


def _orders(spark, sf_dir):
    return view(spark, sf_dir, "scored_orders")


def _docs(spark, sf_dir):
    return view(spark, sf_dir, "scored_docs")


def _round(df, columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _counts_sql(source: str, by: str) -> str:
    return f"""(SELECT {by}, count(*) AS n, CAST(sum(label) AS DOUBLE) AS pos, CAST(sum(prediction) AS DOUBLE) AS pred,
        CAST(sum(label * prediction) AS DOUBLE) AS tp FROM {source} GROUP BY {by})"""


_QUALITY_SQL = """round((n - pos - pred + 2 * tp) / n, 6) AS accuracy, round(coalesce(tp / nullif(pred, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(pos, 0), 0), 6) AS recall, round(coalesce(2 * tp / nullif(pos + pred, 0), 0), 6) AS f1"""


def _ranking_sql(source: str, by: str, score: str) -> str:
    return f"""(SELECT {by}, round(sum(neg * (tps - pos / 2)) / nullif(max(all_pos) * max(all_neg), 0), 6) AS roc_auc,
        round(coalesce(sum(pos * tps / (tps + fps)) / nullif(max(all_pos), 0), 0), 6) AS pr_auc
      FROM (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps,
                   sum(pos) OVER (PARTITION BY {by}) AS all_pos, sum(neg) OVER (PARTITION BY {by}) AS all_neg
            FROM (SELECT {by}, {score} AS s, CAST(sum(label) AS DOUBLE) AS pos, CAST(count(*) - sum(label) AS DOUBLE) AS neg
                  FROM {source} GROUP BY {by}, {score})
            WINDOW w AS (PARTITION BY {by} ORDER BY s DESC)) GROUP BY {by})"""


@query(
    "confusion_matrix",
    with_views(
        "scored_orders",
        body="""
    SELECT priority, count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
           count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp
    FROM scored_orders GROUP BY priority""",
    ),
)
def confusion_matrix(spark, sf_dir):
    return cl.confusion_matrix(_orders(spark, sf_dir), "label", "prediction", ["priority"])


@query(
    "classification_metrics",
    with_views(
        "scored_docs",
        body=f"""
    SELECT lang, n AS sample_count, round(pos / n, 6) AS actual_rate, round(pred / n, 6) AS predicted_rate, {_QUALITY_SQL}
    FROM {_counts_sql("scored_docs", "lang")}""",
    ),
)
def classification_metrics(spark, sf_dir):
    found = cl.classification_metrics(_docs(spark, sf_dir), "label", "prediction", ["lang"])
    return _round(found, ["actual_rate", "predicted_rate", *cl.QUALITY])


def _ranked(df, by, score):
    return cl.performance(df, "label", "prediction", score, by)


@query("roc_auc", with_views("scored_docs", body=f"SELECT lang, roc_auc FROM {_ranking_sql('scored_docs', 'lang', 'score')}"))
def roc_auc(spark, sf_dir):
    return _ranked(_docs(spark, sf_dir), ["lang"], "score").select("lang", F.round("roc_auc", 6).alias("roc_auc"))


@query(
    "average_precision",
    with_views("scored_orders", body=f"SELECT priority, pr_auc FROM {_ranking_sql('scored_orders', 'priority', PROB)}"),
)
def average_precision(spark, sf_dir):
    return _ranked(_orders(spark, sf_dir), ["priority"], PROB).select("priority", F.round("pr_auc", 6).alias("pr_auc"))


_MONTHLY = f"(SELECT *, date_trunc('month', {DATE}) AS w FROM scored_orders)"
_PERFORMANCE_SQL = f"""
    SELECT snapshot_date, n AS sample_count, round(pos / n, 6) AS actual_default_rate,
           round(pred / n, 6) AS predicted_default_rate, {_QUALITY_SQL}, roc_auc, pr_auc
    FROM {_counts_sql(_MONTHLY, "w")} JOIN {_ranking_sql(_MONTHLY, "w", PROB)} USING (w)
    JOIN (SELECT w, min({DATE}) AS snapshot_date FROM {_MONTHLY} GROUP BY w) USING (w)"""


def _performance(spark, sf_dir):
    return cl.performance_over_time(_orders(spark, sf_dir), DATE, "label", "prediction", PROB)


def _rounded_performance(spark, sf_dir):
    return _round(_performance(spark, sf_dir), [*RATES, *METRICS])


@query("performance_over_time", with_views("scored_orders", body=_PERFORMANCE_SQL))
def performance_over_time(spark, sf_dir):
    return _rounded_performance(spark, sf_dir)


@query(
    "performance_by_week",
    with_views(
        "scored_orders",
        body=_PERFORMANCE_SQL.replace("date_trunc('month'", "date_trunc('week'"),
    ),
)
def performance_by_week(spark, sf_dir):
    found = cl.performance_over_time(_orders(spark, sf_dir), DATE, "label", "prediction", PROB, "week")
    return _round(found, [*RATES, *METRICS])


@query(
    "label_distribution",
    with_views(
        "scored_orders",
        body="""
    SELECT label, count(*) AS n, round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM scored_orders), 6) AS share
    FROM scored_orders GROUP BY label""",
    ),
)
def label_distribution(spark, sf_dir):
    return _round(cl.label_distribution(_orders(spark, sf_dir)), ["share"])


@query(
    "prediction_summary",
    with_views(
        "scored_orders",
        body=f"""
    SELECT {DATE}, count(prediction) AS prediction_count, round(avg(prediction), 10) AS prediction_mean,
           round(avg({PROB}), 10) AS probability_mean FROM scored_orders GROUP BY 1""",
    ),
)
def prediction_summary(spark, sf_dir):
    return _round(cl.prediction_summary(_orders(spark, sf_dir)), ["prediction_mean", "probability_mean"], 10)


@query(
    "best_model",
    with_views(
        "scored_orders",
        body=f"""
    SELECT priority AS model_name, roc_auc FROM {_ranking_sql("scored_orders", "priority", PROB)}
    ORDER BY coalesce(roc_auc, 0) DESC, model_name LIMIT 1""",
    ),
)
def best_model(spark, sf_dir):
    """Order priorities stand for models: the one with the highest ROC-AUC."""
    results = _round(_ranked(_orders(spark, sf_dir), ["priority"], PROB), ["roc_auc"])
    return cl.best_model(results.withColumnRenamed("priority", "model_name")).select("model_name", "roc_auc")


@query(
    "temporal_split",
    with_views(
        "scored_orders",
        body=f"""
    SELECT part, count(*) AS n, CAST(sum(label) AS BIGINT) AS positives, min({DATE}) AS first_date, max({DATE}) AS last_date
    FROM (SELECT *, CASE WHEN {DATE} BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1998-09-30 00:00:00' THEN 'train'
                         WHEN {DATE} BETWEEN TIMESTAMP '1998-10-01 00:00:00' AND TIMESTAMP '2000-03-01 00:00:00' THEN 'test' END AS part
          FROM scored_orders) WHERE part IS NOT NULL GROUP BY part""",
    ),
)
def temporal_split(spark, sf_dir):
    return _split_summary(
        *split_rows(_orders(spark, sf_dir), DATE, ("1996-01-01", "1998-09-30"), ("1998-10-01", "2000-03-01"))
    )


def _split_summary(train, test):
    both = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("label").alias("positives"),
        F.min(DATE).alias("first_date"),
        F.max(DATE).alias("last_date"),
    )


@query(
    "quantile_date_split",
    with_views(
        "scored_orders",
        body=f"""
    SELECT CASE WHEN epoch_us({DATE}) <= cut THEN 'train' ELSE 'test' END AS part, count(*) AS n,
           CAST(sum(label) AS BIGINT) AS positives, min({DATE}) AS first_date, max({DATE}) AS last_date
    FROM scored_orders, (SELECT quantile_cont(epoch_us({DATE}), 0.7) AS cut FROM scored_orders) GROUP BY 1""",
    ),
)
def quantile_date_split(spark, sf_dir):
    return _split_summary(*split_rows(_orders(spark, sf_dir), DATE))


# ---- drift over months ---------------------------------------------------------

_MARKED = f"""(SELECT *, date_trunc('month', {DATE}) AS w,
        {DATE} <= (SELECT min({DATE}) FROM scored_orders) + INTERVAL 3 MONTH AS ref FROM scored_orders)"""


def _long_sql(marked: str, features: list[str]) -> str:
    parts = [f"SELECT w, ref, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM {marked} WHERE {c} IS NOT NULL" for c in features]
    return "(" + " UNION ALL ".join(parts) + ")"


def _psi_sql(marked: str, features: list[str]) -> str:
    long = _long_sql(marked, features)
    return f"""(
      SELECT w, feature, round(sum((q - p) * ln(q / p)), 6) AS psi FROM (
        SELECT g.w, g.feature, g.i,
               (coalesce(rc.c, 0) + 1)::DOUBLE / (g.n_ref + 10) AS p, (coalesce(cc.c, 0) + 1)::DOUBLE / (g.n + 10) AS q
        FROM (SELECT w, feature, n, n_ref, unnest(range(10)) AS i
              FROM (SELECT w, feature, count(*) AS n FROM {long} WHERE w IS NOT NULL GROUP BY 1, 2)
              JOIN (SELECT feature, count(*) AS n_ref FROM {long} WHERE ref GROUP BY 1) USING (feature)) g
        LEFT JOIN (SELECT feature, i, count(*) AS c FROM {_binned_sql(long)} WHERE ref GROUP BY 1, 2) rc
          ON rc.feature = g.feature AND rc.i = g.i
        LEFT JOIN (SELECT w, feature, i, count(*) AS c FROM {_binned_sql(long)} GROUP BY 1, 2, 3) cc
          ON cc.w = g.w AND cc.feature = g.feature AND cc.i = g.i)
      GROUP BY w, feature)"""


def _binned_sql(long: str) -> str:
    steps = " + ".join(f"CASE WHEN v >= {i} * ((hi - lo) / 10) + lo THEN 1 ELSE 0 END" for i in range(1, 10))
    return f"""(SELECT w, ref, feature, v, CASE WHEN v BETWEEN lo AND hi THEN {steps} END AS i
        FROM {long} JOIN (SELECT feature, min(v) AS lo, max(v) AS hi FROM {long} WHERE ref GROUP BY 1) USING (feature))"""


def _ks_sql(marked: str, features: list[str]) -> str:
    long = _long_sql(marked, features)
    return f"""(
      SELECT w, feature, round(max(abs(fr - fc)), 6) AS ks FROM (
        SELECT w, feature, v, sum(r) OVER o / sum(r) OVER (PARTITION BY w, feature) AS fr,
               sum(c) OVER o / sum(c) OVER (PARTITION BY w, feature) AS fc
        FROM (SELECT w, feature, v, sum(r)::DOUBLE AS r, sum(c)::DOUBLE AS c FROM (
                SELECT w, feature, v, 0 AS r, 1 AS c FROM {long} WHERE w IS NOT NULL
                UNION ALL
                SELECT x.w, l.feature, l.v, 1, 0
                FROM {long} l JOIN (SELECT DISTINCT w, feature FROM {long} WHERE w IS NOT NULL) x ON x.feature = l.feature
                WHERE l.ref)
              GROUP BY 1, 2, 3)
        WINDOW o AS (PARTITION BY w, feature ORDER BY v))
      GROUP BY w, feature)"""


def _marked(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    early = dr.first_months(rows, DATE)
    marked = dr.mark(rows, early, F.date_trunc("month", F.col(DATE)))
    return marked, dr.fit_reference(rows.where(early), FEATURES, PROB, "label")


@query(
    "histogram_ref_bins",
    with_views(
        "scored_orders",
        body=f"""
    SELECT feature, i AS bin, count(*) AS n, count(*) FILTER (ref) AS n_ref
    FROM {_binned_sql(_long_sql(_MARKED, FEATURES))} GROUP BY 1, 2""",
    ),
)
def histogram_ref_bins(spark, sf_dir):
    marked, ref = _marked(spark, sf_dir)
    counts = dr.bin_counts(ref, dr.unfold_cells(marked, dr.with_edges(ref, {})))
    return counts.groupBy("feature", "bin").agg(F.sum("n").alias("n"), F.sum("n_ref").alias("n_ref"))


@query("psi", with_views("scored_orders", body=f"SELECT w AS window, feature, psi FROM {_psi_sql(_MARKED, FEATURES)}"))
def psi(spark, sf_dir):
    return _round(dr.psi(*_marked(spark, sf_dir)), ["psi"])


@query("ks_statistic", with_views("scored_orders", body=f"SELECT w AS window, feature, ks FROM {_ks_sql(_MARKED, FEATURES)}"))
def ks_statistic(spark, sf_dir):
    return _round(dr.ks(*_marked(spark, sf_dir)), ["ks"])


_DRIFT_SQL = f"""(SELECT w, min({DATE}) AS snapshot_date, (SELECT count(*) FROM {_MARKED} WHERE ref) AS reference_sample_count,
        count(*) AS current_sample_count,
        round(abs(avg({PROB}) - (SELECT avg({PROB}) FROM {_MARKED} WHERE ref)), 6) AS prediction_drift,
        round(abs(avg(label) - (SELECT avg(label) FROM {_MARKED} WHERE ref)), 6) AS label_drift
      FROM {_MARKED} GROUP BY w)"""


@query(
    "prediction_drift",
    with_views("scored_orders", body=f"SELECT snapshot_date, current_sample_count, prediction_drift FROM {_DRIFT_SQL}"),
)
def prediction_drift(spark, sf_dir):
    found = dr.mean_drift(*_marked(spark, sf_dir), PROB, "label", DATE)
    return _round(found, ["prediction_drift"]).select("snapshot_date", "current_sample_count", "prediction_drift")


@query(
    "label_drift",
    with_views("scored_orders", body=f"SELECT snapshot_date, reference_sample_count, label_drift FROM {_DRIFT_SQL}"),
)
def label_drift(spark, sf_dir):
    found = dr.mean_drift(*_marked(spark, sf_dir), PROB, "label", DATE)
    return _round(found, ["label_drift"]).select("snapshot_date", "reference_sample_count", "label_drift")


_STABILITY_COLUMNS = ["mean_psi", "max_psi", "mean_ks", "max_ks", "prediction_drift", "label_drift"]
_STABILITY_SQL = f"""
    SELECT snapshot_date, reference_sample_count, current_sample_count, round(mean_psi, 4) AS mean_psi, round(max_psi, 4) AS max_psi,
           round(mean_ks, 4) AS mean_ks, round(max_ks, 4) AS max_ks, round(prediction_drift, 4) AS prediction_drift,
           round(label_drift, 4) AS label_drift
    FROM {_DRIFT_SQL.replace(", 6) AS", ", 12) AS")}
    JOIN (SELECT w, avg(psi) AS mean_psi, max(psi) AS max_psi FROM {_psi_sql(_MARKED, FEATURES).replace(", 6) AS psi", ", 12) AS psi")} GROUP BY w) USING (w)
    JOIN (SELECT w, avg(ks) AS mean_ks, max(ks) AS max_ks FROM {_ks_sql(_MARKED, FEATURES).replace(", 6) AS ks", ", 12) AS ks")} GROUP BY w) USING (w)"""


def _stability(spark, sf_dir):
    return dr.stability_over_time(_orders(spark, sf_dir), DATE, FEATURES)


def _scores_sql(name: str, scores: str) -> str:
    """One column per feature from the scores of each window."""
    columns = ", ".join(f"max(CASE WHEN feature = '{f}' THEN {name} END) AS {name}_{f}" for f in FEATURES)
    return f"(SELECT w, {columns} FROM {scores} GROUP BY w)"


_SCORE_COLUMNS = [f"{name}_{f}" for name in ("psi", "ks") for f in FEATURES]


@query(
    "stability_over_time",
    with_views(
        "scored_orders",
        body=f"""
    SELECT s.*, {", ".join(_SCORE_COLUMNS)} FROM ({_STABILITY_SQL.replace(", 4) AS", ", 6) AS")}) s
    JOIN (SELECT w, min({DATE}) AS snapshot_date FROM {_MARKED} GROUP BY w) d USING (snapshot_date)
    JOIN {_scores_sql("psi", _psi_sql(_MARKED, FEATURES))} USING (w)
    JOIN {_scores_sql("ks", _ks_sql(_MARKED, FEATURES))} USING (w)""",
    ),
)
def stability_over_time(spark, sf_dir):
    """With the scores of each feature, from the maps, as columns."""
    found = _stability(spark, sf_dir)
    scores = {f"{name}_{f}": F.col(f"{name}_scores")[f] for name in ("psi", "ks") for f in FEATURES}
    return _round(found.withColumns(scores).drop("psi_scores", "ks_scores"), [*_STABILITY_COLUMNS, *scores])


@query(
    "drift_alerts",
    with_views(
        "scored_orders",
        body=f"""
    SELECT snapshot_date, psi_alert, f1_alert, f1_alert OR psi_alert = 'critical' AS retrain FROM (
      SELECT snapshot_date, CASE WHEN max_psi >= 0.25 THEN 'critical' WHEN max_psi >= 0.1 THEN 'warning' ELSE 'ok' END AS psi_alert,
             first_value(f1) OVER (ORDER BY snapshot_date) - f1 > 0.05 AS f1_alert
      FROM ({_PERFORMANCE_SQL}) JOIN ({_STABILITY_SQL}) USING (snapshot_date))""",
    ),
)
def drift_alerts(spark, sf_dir):
    found = dr.drift_alerts(_performance(spark, sf_dir), _stability(spark, sf_dir))
    return found.select("snapshot_date", "psi_alert", "f1_alert", "retrain")


# ---- first half against second half --------------------------------------------

_HALVES = f"""(SELECT *, CASE WHEN early THEN NULL ELSE 'current' END AS w, early AS ref FROM (
        SELECT *, epoch_us({DATE}) <= (SELECT quantile_cont(epoch_us({DATE}), 0.5) FROM scored_orders) AS early FROM scored_orders))"""
_CATEGORIES = ["priority", "status"]


def _category_sql(column: str) -> str:
    return f"""SELECT '{column}' AS feature, {column} AS category, count(*) FILTER (ref) AS r, count(*) FILTER (NOT ref) AS c
        FROM {_HALVES} GROUP BY 2"""


_CATEGORICAL_PSI_SQL = f"""(
    SELECT feature, count(*) AS categories, round(sum((q - p) * ln(q / p)), 6) AS psi FROM (
      SELECT feature, (r + 1)::DOUBLE / (sum(r) OVER f + count(*) OVER f) AS p, (c + 1)::DOUBLE / (sum(c) OVER f + count(*) OVER f) AS q
      FROM ({" UNION ALL ".join(_category_sql(c) for c in _CATEGORIES)}) WINDOW f AS (PARTITION BY feature))
    GROUP BY feature)"""


def _half(df):
    return F.col(DATE) <= dr.median_date(df, DATE)


@query("categorical_psi", with_views("scored_orders", body=f"SELECT * FROM {_CATEGORICAL_PSI_SQL}"))
def categorical_psi(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    return _round(dr.categorical_psi(rows, _half(rows), _CATEGORIES), ["psi"])


@query(
    "category_shares",
    with_views(
        "scored_orders",
        body=f"""
    SELECT feature, category, r AS n_reference, c AS n_current,
           round(c::DOUBLE / sum(c) OVER f - r::DOUBLE / sum(r) OVER f, 6) AS share_change
    FROM ({" UNION ALL ".join(_category_sql(c) for c in _CATEGORIES)}) WINDOW f AS (PARTITION BY feature)""",
    ),
)
def category_shares(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    found = dr.category_shares(rows, _half(rows), _CATEGORIES)
    return _round(found, ["share_change"]).drop("share_reference", "share_current")


_REPORT_SQL = f"""
    SELECT feature, 'numeric' AS kind, psi, ks, psi >= 0.1 AS drifted
    FROM {_psi_sql(_HALVES, FEATURES)} JOIN {_ks_sql(_HALVES, FEATURES)} USING (w, feature)
    UNION ALL SELECT feature, 'categorical', psi, CAST(NULL AS DOUBLE), psi >= 0.1 FROM {_CATEGORICAL_PSI_SQL}"""


def _report(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    return dr.drift_report(rows, _half(rows), FEATURES, _CATEGORIES)


@query("drift_report", with_views("scored_orders", body=_REPORT_SQL))
def drift_report(spark, sf_dir):
    return _round(_report(spark, sf_dir), ["psi", "ks"])


@query(
    "drift_summary",
    with_views(
        "scored_orders",
        body=f"""
    SELECT count(*) AS features, count(*) FILTER (drifted) AS drifted_features,
           round(CAST(count(*) FILTER (drifted) AS DOUBLE) / count(*), 6) AS drifted_share FROM ({_REPORT_SQL})""",
    ),
)
def drift_summary(spark, sf_dir):
    return _round(dr.drift_summary(_report(spark, sf_dir)), ["drifted_share"])


_REPORTED = ["amount", "part_amount", "status"]


@query(
    "missing_values_report",
    with_views(
        "scored_orders",
        body=" UNION ALL ".join(
            f"""
    SELECT '{c}' AS column_name, count(*) FILTER (ref AND {c} IS NULL) AS missing_reference,
           count(*) FILTER (NOT ref AND {c} IS NULL) AS missing_current,
           round(CAST(count(*) FILTER (ref AND {c} IS NULL) AS DOUBLE) / count(*) FILTER (ref), 6) AS share_reference,
           round(CAST(count(*) FILTER (NOT ref AND {c} IS NULL) AS DOUBLE) / count(*) FILTER (NOT ref), 6) AS share_current
    FROM {_HALVES}"""
            for c in _REPORTED
        ),
    ),
)
def missing_values_report(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    found = dr.missing_values_report(rows, _half(rows), _REPORTED)
    return _round(found, ["share_reference", "share_current"])


@query(
    "target_shift",
    with_views(
        "scored_orders",
        body=f"""
    SELECT round(r, 6) AS reference_rate, round(c, 6) AS current_rate, round(abs(c - r), 6) AS shift
    FROM (SELECT avg(label) FILTER (ref) AS r, avg(label) FILTER (NOT ref) AS c FROM {_HALVES})""",
    ),
)
def target_shift(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    return _round(dr.target_shift(rows, _half(rows), "label"), ["reference_rate", "current_rate", "shift"])


# ---- chart tables --------------------------------------------------------------


def _unpivot_sql(source: str, metrics: list[str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT snapshot_date, '{m}' AS metric, {m} AS value{extra.format(m=m)} FROM ({source})" for m in metrics
    )


@query(
    "chart_performance_long",
    with_views("scored_orders", body=_unpivot_sql(_PERFORMANCE_SQL, list(charts.PERFORMANCE))),
)
def chart_performance_long(spark, sf_dir):
    return charts.performance_long(_rounded_performance(spark, sf_dir))


@query(
    "chart_rate_comparison",
    with_views(
        "scored_orders",
        body=f"""
    SELECT snapshot_date, round(actual_default_rate * 100, 4) AS actual_pct, round(predicted_default_rate * 100, 4) AS predicted_pct
    FROM ({_PERFORMANCE_SQL})""",
    ),
)
def chart_rate_comparison(spark, sf_dir):
    return _round(charts.rate_comparison(_rounded_performance(spark, sf_dir)), ["actual_pct", "predicted_pct"], 4)


@query(
    "chart_confusion_evolution",
    with_views("scored_orders", body=f"SELECT snapshot_date, accuracy, precision, recall, f1 FROM ({_PERFORMANCE_SQL})"),
)
def chart_confusion_evolution(spark, sf_dir):
    return charts.confusion_evolution(_rounded_performance(spark, sf_dir))


@query(
    "chart_sample_counts",
    with_views("scored_orders", body=f"SELECT snapshot_date, sample_count FROM ({_PERFORMANCE_SQL})"),
)
def chart_sample_counts(spark, sf_dir):
    return charts.sample_counts(_performance(spark, sf_dir))


@query(
    "chart_stability_long",
    with_views(
        "scored_orders",
        body=_unpivot_sql(
            _STABILITY_SQL,
            _STABILITY_COLUMNS,
            ", CASE WHEN '{m}' LIKE '%psi%' THEN CAST(0.1 AS DOUBLE) END AS warning_line, "
            "CASE WHEN '{m}' LIKE '%psi%' THEN CAST(0.25 AS DOUBLE) END AS critical_line",
        ),
    ),
)
def chart_stability_long(spark, sf_dir):
    return _round(charts.stability_long(_stability(spark, sf_dir)), ["value"], 4)


@query(
    "dashboard",
    with_views(
        "scored_orders",
        body=f"""
    SELECT snapshot_date, sample_count, accuracy, precision, recall, f1, roc_auc,
           round(actual_default_rate * 100, 4) AS actual_pct, round(predicted_default_rate * 100, 4) AS predicted_pct,
           mean_psi, max_psi, prediction_drift
    FROM ({_PERFORMANCE_SQL}) JOIN ({_STABILITY_SQL}) USING (snapshot_date)""",
    ),
)
def dashboard(spark, sf_dir):
    found = charts.dashboard(_rounded_performance(spark, sf_dir), _stability(spark, sf_dir))
    out = _round(found, ["actual_pct", "predicted_pct", "mean_psi", "max_psi", "prediction_drift"], 4)
    return out


