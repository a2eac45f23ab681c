"""Classification quality: confusion counts, rates, ROC-AUC and average precision."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numeric import ratio_or_zero
from .running import BUCKET, add_bucket, add_running, known, sums_before, value_splits

COUNTS = ("n", "pos", "pred_pos", "tp")
QUALITY = ("accuracy", "precision", "recall", "f1")


def _count_columns(y: str, yhat: str) -> list[Column]:
    actual, predicted = F.col(y) == 1, F.col(yhat) == 1
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(actual).alias("pos"),
        F.count_if(predicted).alias("pred_pos"),
        F.count_if(actual & predicted).alias("tp"),
    ]


def confusion_matrix(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    actual, predicted = F.col(y) == 1, F.col(yhat) == 1
    return df.groupBy(*by).agg(
        F.count_if(~actual & ~predicted).alias("tn"),
        F.count_if(~actual & predicted).alias("fp"),
        F.count_if(actual & ~predicted).alias("fn"),
        F.count_if(actual & predicted).alias("tp"),
    )


def _quality() -> dict[str, Column]:
    """From n, pos, pred_pos, tp; a zero denominator gives 0."""
    n, pos, pred, tp = (F.col(c) for c in COUNTS)
    return {
        "sample_count": n,
        "actual_rate": F.try_divide(pos.cast("double"), n.cast("double")),
        "predicted_rate": F.try_divide(pred.cast("double"), n.cast("double")),
        "accuracy": ratio_or_zero(n - pos - pred + 2 * tp, n),
        "precision": ratio_or_zero(tp, pred),
        "recall": ratio_or_zero(tp, pos),
        "f1": ratio_or_zero(2 * tp, pos + pred),
    }


def classification_metrics(df: DataFrame, y: str, yhat: str, by: Sequence[str] = ()) -> DataFrame:
    counts = df.groupBy(*by).agg(*_count_columns(y, yhat))
    return counts.select(*by, *[c.alias(n) for n, c in _quality().items()])


def performance(
    df: DataFrame,
    y: str,
    yhat: str,
    score: str,
    by: Sequence[str] = (),
    splits: Sequence[float] | None = None,
    first: str | None = None,
    keep_counts: bool = False,
) -> DataFrame:
    """Confusion-based quality, ROC-AUC (ties count half) and average precision per group.

    ROC-AUC is NULL with one class only; average precision is 0 without positives;
    both are NULL when a score is missing. Rows whose group is NULL are left out.
    ``first`` carries the smallest value of a column per group, ``keep_counts`` the
    counts behind the rates.

    Two aggregates read the rows: one per (group, score range), a small table that
    gives all totals and the counts above each range, and one per (group, score).
    """
    if splits is None:
        splits = value_splits(df, [score])[score]
    keys = list(by) or ["_all"]
    grouped = df if by else df.withColumn("_all", F.lit(0))
    for k in keys:
        grouped = grouped.where(F.col(k).isNotNull())
    rows = add_bucket(grouped.withColumn(score, F.expr(known(score))), score, splits)

    carried = [F.min(first).alias("_first")] if first else []
    ranges = rows.groupBy(*keys, BUCKET).agg(
        *_count_columns(y, yhat), F.count_if(F.col(score).isNull()).alias("unscored"), *carried
    )
    whole = W.partitionBy(*keys)
    offsets = ranges.withColumn("neg", F.col("n") - F.col("pos")).select(
        *keys,
        BUCKET,
        *sums_before(keys, ["pos", "neg"], descending=True),
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in (*COUNTS, "unscored")],
        *([F.min("_first").over(whole).alias("_first")] if first else []),
    )
    counts = rows.groupBy(*keys, BUCKET, score).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.coalesce(F.col(y) != 1, F.lit(True))).alias("neg")
    )
    curve = add_running(counts, offsets, keys, score, ["pos", "neg"], descending=True)
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "pos_run", "neg_run"))
    sums = curve.groupBy(*keys).agg(
        F.sum(neg * (tp - pos / 2)).alias("_area"),
        F.sum(F.try_divide(pos * tp, tp + fp)).alias("_steps"),
        *[F.max(f"{c}_total").alias(c) for c in (*COUNTS, "unscored")],
        *([F.min("_first").alias(first)] if first else []),
    )
    scored = F.col("unscored") == 0
    n_pos, n_neg = F.col("pos").cast("double"), (F.col("n") - F.col("pos")).cast("double")
    return sums.select(
        *by,
        *([first] if first else []),
        *[c.alias(n) for n, c in _quality().items()],
        F.when(scored, F.try_divide(F.col("_area"), n_pos * n_neg)).alias("roc_auc"),
        F.when(scored, ratio_or_zero(F.col("_steps"), n_pos)).alias("pr_auc"),
        *(COUNTS if keep_counts else ()),
    )


def performance_over_time(
    df: DataFrame, date: str, y: str, yhat: str, score: str, unit: str = "month", splits: Sequence[float] | None = None
) -> DataFrame:
    """One row per calendar window; ``snapshot_date`` is the first date seen in it."""
    windows = df.withColumn("_window", F.date_trunc(unit, F.col(date)))
    out = performance(windows, y, yhat, score, ["_window"], splits, first=date)
    return out.drop("_window").withColumnsRenamed(
        {date: "snapshot_date", "actual_rate": "actual_default_rate", "predicted_rate": "predicted_default_rate"}
    )


def best_model(results: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """The row with the highest metric (missing counts as 0), by name among equals."""
    return results.orderBy(F.coalesce(F.col(metric), F.lit(0.0)).desc(), "model_name").limit(1)


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """(label, n, share); the total is added up from the one row per label."""
    n = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    return n.withColumn("share", F.try_divide(F.col("n").cast("double"), total.cast("double")))


def prediction_summary(df: DataFrame, date: str = "feature_snapshot_date") -> DataFrame:
    return df.groupBy(date).agg(
        F.count("prediction").alias("prediction_count"),
        F.avg("prediction").alias("prediction_mean"),
        F.avg("prediction_proba_1").alias("probability_mean"),
    )
