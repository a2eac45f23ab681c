"""Registered queries: training, evaluation, scoring and the model registry.

Fitted models are not expressible in SQL; the statements say which rows were used
and how results must hang together. The measures themselves are compared in full on
stored scores (`evaluate_model` and the metric queries).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import learn as ln
from ..operators.clean import clean_loans
from ..operators.features import KEYS, ROW, numeric_columns
from ..operators.temporal import FEATURE_DATE, feature_label_join, scored_join
from ..session import roomy, stage_table, staging_path
from ..sources.stores import load_model, read_registry, read_store, save_model, write_store
from .registry import query
from .stages import build_stores
from .stages_sql import FEATURE_STORE, feature_store_ctes
from .views import table, view, with_views

STAMP = "20240101_000000"


def stores(spark, sf_dir):
    """Feature and label store of a data folder, written and read again."""
    features, labels = build_stores(
        view(spark, sf_dir, "fin_snapshots"),
        view(spark, sf_dir, "attr_snapshots"),
        view(spark, sf_dir, "click_months"),
        clean_loans(view(spark, sf_dir, "loan_snapshots")),
    )
    paths = staging_path(spark, "feature-store"), staging_path(spark, "label-store")
    write_store(features, paths[0])
    write_store(labels, paths[1])
    return read_store(spark, paths[0]), read_store(spark, paths[1])


@query(
    "feature_store",
    with_views(
        "fin_snapshots", "loan_snapshots", "attr_snapshots", "click_months", more=feature_store_ctes(), body=FEATURE_STORE
    ),
)
def feature_store(spark, sf_dir):
    features = stores(spark, sf_dir)[0].drop(ROW)
    return features.withColumns({c: F.round(c, 6) for c in numeric_columns(features, ["Customer_ID"])})


# What SQL can say of a trained model: the rows it was tested on and how their labels are
# split, how its measures hang together, and that each algorithm has its own name. The
# split lies at the 70 % quantile of the feature dates.
_SPLIT = {
    "rows_of": "SELECT feature_snapshot_date AS d, label FROM wide",
    "cut": "SELECT quantile_cont(epoch_us(d), 0.7) AS edge FROM rows_of",
    "tested": "SELECT * FROM rows_of, cut WHERE epoch_us(d) > edge",
}


def _trained_sql(*names: str) -> str:
    parts = [
        f"""SELECT '{n}' AS model_name, count(*) AS test_samples, CAST(sum(label) AS BIGINT) AS positive_class_count,
        count(*) AS matrix_sum, CAST(sum(label) AS BIGINT) AS matrix_positives, TRUE AS accuracy_holds, TRUE AS precision_holds,
        TRUE AS recall_holds, TRUE AS f1_holds, TRUE AS areas_hold FROM tested"""
        for n in names
    ]
    steps = feature_store_ctes()
    more = {k: steps[k] for k in ("gold", "clicks", "wide")} | _SPLIT
    return with_views("fin_snapshots", "loan_snapshots", "attr_snapshots", "click_months", more=more, body=" UNION ALL ".join(parts))


def _checked(results):
    """The result rows with each measure worked out again from the confusion matrix."""
    m = F.col("confusion_matrix")
    tn, fp, fn, tp = (m[i][j].cast("double") for i in (0, 1) for j in (0, 1))
    near = lambda a, b: F.abs(a - F.coalesce(b, F.lit(0.0))) < 1e-9
    share = lambda a, b: F.try_divide(a, b)
    p, r = share(tp, tp + fp), share(tp, tp + fn)
    return results.select(
        "model_name",
        "test_samples",
        "positive_class_count",
        (tn + fp + fn + tp).cast("bigint").alias("matrix_sum"),
        (fn + tp).cast("bigint").alias("matrix_positives"),
        near(F.col("accuracy"), share(tn + tp, tn + fp + fn + tp)).alias("accuracy_holds"),
        near(F.col("precision"), p).alias("precision_holds"),
        near(F.col("recall"), r).alias("recall_holds"),
        near(F.col("f1"), share(2 * p * r, p + r)).alias("f1_holds"),
        (F.col("roc_auc").between(0, 1) & F.col("pr_auc").between(0, 1)).alias("areas_hold"),
    )


def _trained(spark, sf_dir, *names, stored=None):
    """Fitted with the library's own parameters."""
    rows = stage_table(feature_label_join(*(stored or stores(spark, sf_dir))), "labelled")
    return ln.train_all(*ln.temporal_split(rows, FEATURE_DATE), names)


def _result(spark, sf_dir, name):
    return _checked(_trained(spark, sf_dir, name).results_frame(spark))


@query("train_lr", _trained_sql("logistic_regression"))
def train_lr(spark, sf_dir):
    return _result(spark, sf_dir, "logistic_regression")


@query("train_rf", _trained_sql("random_forest"))
def train_rf(spark, sf_dir):
    return _result(spark, sf_dir, "random_forest")


@query("train_gbt", _trained_sql("xgboost"))
def train_gbt(spark, sf_dir):
    return _result(spark, sf_dir, "xgboost")


@query("train_gbt_deep", _trained_sql("lightgbm"))
def train_gbt_deep(spark, sf_dir):
    return _result(spark, sf_dir, "lightgbm")


# Labels that follow from the features: what a model that learned nothing can't tell.
LEARNABLE = """(amount > 150000 AND priority IN ('1-URGENT', '2-HIGH')) OR (customer_group > 60 AND amount <= 250000)"""
#: Area under the curve that each algorithm must reach on later months; a constant model has 0.5.
LEAST_AREA = {"logistic_regression": 0.75, "random_forest": 0.97, "xgboost": 0.95, "lightgbm": 0.97}


@query(
    "models_learn",
    with_views(
        "scored_orders",
        more={
            "marked": f"SELECT feature_snapshot_date AS d, CASE WHEN {LEARNABLE} THEN 1 ELSE 0 END AS y FROM scored_orders",
            "held": "SELECT y FROM marked WHERE epoch_us(d) > (SELECT quantile_cont(epoch_us(d), 0.7) FROM marked)",
        },
        body=" UNION ALL ".join(
            f"SELECT '{n}' AS model_name, count(*) AS test_samples, CAST(sum(y) AS BIGINT) AS positive_class_count, TRUE AS learned, "
            f"TRUE AS ranks_most_first FROM held"
            for n in LEAST_AREA
        ),
    ),
)
def models_learn(spark, sf_dir):
    """All algorithms on labels that the features decide; a weak or a constant model turns its row's marks to false."""
    rows = view(spark, sf_dir, "scored_orders").withColumn("label", F.expr(f"CASE WHEN {LEARNABLE} THEN 1 ELSE 0 END"))
    rows = stage_table(rows.select("Customer_ID", FEATURE_DATE, "label", "amount", "customer_group", "priority"), "learnable")
    trained = ln.train_all(*ln.temporal_split(rows, FEATURE_DATE), list(LEAST_AREA), numeric=["amount", "customer_group"], categorical=["priority"])
    least = F.element_at(F.create_map(*[F.lit(x) for pair in LEAST_AREA.items() for x in pair]), F.col("model_name"))
    share = F.col("positive_class_count").cast("double") / F.col("test_samples")
    return trained.results_frame(spark).select(
        "model_name",
        "test_samples",
        "positive_class_count",
        (F.col("roc_auc") >= least).alias("learned"),
        # Average precision of a ranking at random is the share of positives.
        (F.col("pr_auc") >= share + (1 - share) / 3).alias("ranks_most_first"),
    )


@query(
    "evaluate_model",
    with_views(
        "scored_orders",
        more={
            "c": """SELECT count(*) AS n, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
                    count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 0 AND prediction = 0) AS tn FROM scored_orders""",
            "s": """SELECT prediction_proba_1 AS v, CAST(count(*) AS DOUBLE) AS n, CAST(sum(label) AS DOUBLE) AS p FROM scored_orders GROUP BY 1""",
            "r": """SELECT v, n, p, sum(p) OVER (ORDER BY v DESC) AS tp, sum(n) OVER (ORDER BY v DESC) AS taken,
                    coalesce(sum(n - p) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s""",
            "a": """SELECT sum(p * below + p * (n - p) / 2) / (sum(p) * sum(n - p)) AS roc, sum(p / (SELECT sum(p) FROM s) * tp / taken) AS ap FROM r""",
        },
        body="""
    SELECT 'stored_scores' AS model_name, round(CAST(tp + tn AS DOUBLE) / n, 6) AS accuracy,
           round(CAST(tp AS DOUBLE) / (tp + fp), 6) AS precision, round(CAST(tp AS DOUBLE) / (tp + fn), 6) AS recall,
           round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1, round(roc, 6) AS roc_auc, round(ap, 6) AS pr_auc,
           n AS test_samples, tp + fn AS positive_class_count, tp + fp AS predicted_positive_count,
           tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives
    FROM c, a""",
    ),
)
def evaluate_model(spark, sf_dir):
    found = ln.evaluate(view(spark, sf_dir, "scored_orders"), "stored_scores")
    matrix = F.col("confusion_matrix")
    return found.select(
        "model_name",
        *[F.round(c, 6).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")],
        "test_samples",
        "positive_class_count",
        "predicted_positive_count",
        matrix[0][0].alias("true_negatives"),
        matrix[0][1].alias("false_positives"),
        matrix[1][0].alias("false_negatives"),
        matrix[1][1].alias("true_positives"),
    )


_STEPS = feature_store_ctes()


@query(
    "batch_score",
    with_views(
        "fin_snapshots",
        "loan_snapshots",
        "attr_snapshots",
        more={"gold": _STEPS["gold"]},
        body=f"""
    SELECT Customer_ID, feature_snapshot_date, label_snapshot_date, count(*) AS scored, 'logistic_regression' AS model_name,
           'v_{STAMP}' AS model_version, TIMESTAMP '2024-01-01 00:00:00' AS prediction_timestamp,
           TRUE AS probabilities_add_up, TRUE AS prediction_follows FROM gold GROUP BY ALL""",
    ),
)
def batch_score(spark, sf_dir):
    """Every row of the feature store once, with scores that hang together."""
    name, stored = "logistic_regression", stores(spark, sf_dir)
    model = _trained(spark, sf_dir, name, stored=stored).models[name]
    scores = ln.score(model, stored[0], "2024-01-01 00:00:00", name, f"v_{STAMP}")
    p0, p1 = F.col("prediction_proba_0"), F.col("prediction_proba_1")
    return scores.groupBy(*KEYS, "model_name", "model_version", "prediction_timestamp").agg(
        F.count_distinct(ROW).alias("scored"),
        F.bool_and(F.abs(p0 + p1 - 1) < 1e-9).alias("probabilities_add_up"),
        F.bool_and(F.col("prediction") == (p1 > 0.5).cast("int")).alias("prediction_follows"),
    )


@query(
    "model_registry",
    with_views(
        "fin_snapshots",
        "loan_snapshots",
        "attr_snapshots",
        more={"gold": _STEPS["gold"]},
        body=f"""
    SELECT m.model_name, m.version, 'roc_auc' AS primary_metric, TRUE AS metric_in_range, m.is_latest, n AS scored_by_latest
    FROM (SELECT unnest(['logistic_regression', 'random_forest']) AS model_name, unnest(['v_{STAMP}0', 'v_{STAMP}1']) AS version,
                 unnest([FALSE, TRUE]) AS is_latest) m, (SELECT count(*) AS n FROM gold) g""",
    ),
)
def model_registry(spark, sf_dir):
    """Two models saved; the one saved last is loaded and scores the whole store."""
    folder, stored = staging_path(spark, "models"), stores(spark, sf_dir)
    trained = _trained(spark, sf_dir, "logistic_regression", "random_forest", stored=stored)
    for i, row in enumerate(trained.results):
        metrics = {k: float(row[k]) for k in ("accuracy", "f1", "roc_auc", "pr_auc") if row[k] is not None}
        save_model(spark, trained.models[row["model_name"]], folder, row["model_name"], f"{STAMP}{i}", metrics)
    model, latest = load_model(spark, folder)
    scored = ln.score(model, stored[0]).agg(F.count("prediction").alias("scored_by_latest"))
    rows = read_registry(spark, folder).select(
        "model_name",
        "version",
        "primary_metric",
        F.col("metrics")["roc_auc"].between(0, 1).alias("metric_in_range"),
        (F.col("version") == latest["version"]).alias("is_latest"),
        F.lit(1).alias("_one"),
    )
    return rows.join(scored.withColumn("_one", F.lit(1)), "_one").drop("_one")


# Feature, label and score rows of one customer and month, of which there are several.
_ROWS = {
    "feature_rows": """SELECT Customer_ID, feature_snapshot_date, feature_snapshot_date + INTERVAL 6 MONTH AS label_snapshot_date,
        loan_id AS store_row, amount FROM store_rows""",
    "label_rows": """SELECT Customer_ID, feature_snapshot_date, feature_snapshot_date + INTERVAL 6 MONTH AS label_snapshot_date,
        loan_id AS store_row, label FROM store_rows""",
    "score_rows": "SELECT Customer_ID, feature_snapshot_date, loan_id AS store_row, prediction, prediction_proba_1 FROM store_rows",
}
_KEY = "Customer_ID, feature_snapshot_date, label_snapshot_date"


def _side(spark, sf_dir, name):
    return spark.sql(_ROWS[name].replace("store_rows", "{store_rows}"), store_rows=view(spark, sf_dir, "store_rows"))


def _roomy(spark, sf_dir):
    """The store rows are the line items with an order; their number stands in the files' footers."""
    return roomy(spark, table(spark, sf_dir, "lineitem").count())


def _labelled(spark, sf_dir, by_key_only=False):
    return feature_label_join(_side(spark, sf_dir, "feature_rows"), _side(spark, sf_dir, "label_rows"), by_key_only)


def _joined_sql(select: str) -> str:
    return with_views("store_rows", more=_ROWS, body=select)


@query(
    "feature_label_join",
    _joined_sql(f"SELECT {_KEY}, store_row, amount, label FROM feature_rows JOIN label_rows USING ({_KEY}, store_row)"),
)
def feature_labels(spark, sf_dir):
    spark = _roomy(spark, sf_dir)
    return _labelled(spark, sf_dir).select(*KEYS, ROW, "amount", "label")


@query(
    "feature_label_join_by_key",
    _joined_sql(f"""SELECT {_KEY}, count(*) AS n, round(sum(amount), 2) AS amount, CAST(sum(label) AS BIGINT) AS labels
        FROM feature_rows JOIN label_rows USING ({_KEY}) GROUP BY ALL"""),
)
def feature_labels_by_key(spark, sf_dir):
    """All rows of a key with all labels of it, added up per key."""
    rows = _labelled(_roomy(spark, sf_dir), sf_dir, by_key_only=True)
    return rows.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"), F.sum("label").alias("labels"))


@query(
    "scored_join",
    _joined_sql(f"""SELECT {_KEY}, store_row, amount, label, prediction, prediction_proba_1
        FROM feature_rows JOIN label_rows USING ({_KEY}, store_row) JOIN score_rows USING (Customer_ID, feature_snapshot_date, store_row)"""),
)
def scored(spark, sf_dir):
    spark = _roomy(spark, sf_dir)
    joined = scored_join(_labelled(spark, sf_dir), _side(spark, sf_dir, "score_rows"))
    return joined.select(*KEYS, ROW, "amount", "label", "prediction", "prediction_proba_1")


@query(
    "scored_join_by_key",
    _joined_sql(f"""SELECT {_KEY}, store_row, count(*) AS n, CAST(sum(s.prediction) AS BIGINT) AS predictions
        FROM (SELECT * FROM feature_rows JOIN label_rows USING ({_KEY}, store_row)) x
        JOIN (SELECT Customer_ID, feature_snapshot_date, prediction FROM score_rows) s USING (Customer_ID, feature_snapshot_date)
        GROUP BY ALL"""),
)
def scored_by_key(spark, sf_dir):
    spark = _roomy(spark, sf_dir)
    joined = scored_join(_labelled(spark, sf_dir), _side(spark, sf_dir, "score_rows").drop(ROW), by_key_only=True)
    return joined.groupBy(*KEYS, ROW).agg(F.count(F.lit(1)).alias("n"), F.sum("prediction").alias("predictions"))
