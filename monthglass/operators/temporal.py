"""Joins between snapshots: features at T with outcomes at T plus m months."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import plus_months
from .features import KEYS, ROW, binary_label
from .spread import spread_join

FEATURE_DATE, LABEL_DATE = "feature_snapshot_date", "label_snapshot_date"


def _equal(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def _outcomes(
    loans: DataFrame, key: str, date: str, months: int, threshold: float, carry: Sequence[str]
) -> DataFrame:
    """The outcome rows at ``months`` on book, cut to the columns the join needs."""
    return loans.where(F.col("mob") == months).select(
        F.col(key).alias("_key"),
        F.col(date).alias("_date"),
        binary_label(F.col("dpd"), threshold).alias("label"),
        *carry,
    )


def temporal_label_join(
    features: DataFrame,
    loans: DataFrame,
    months: int = 6,
    threshold: float = 30,
    key: str = "Customer_ID",
    date: str = "snapshot_date",
    carry: Sequence[str] = ("dpd", "overdue_amt"),
    null_safe: bool = False,
    spread: bool = False,
) -> DataFrame:
    """Each feature row at T with every outcome of the same key at exactly T + months.

    One equi-join on (key, date): the date is part of the hash key, so the rows of
    a very active key are spread over its months. A key with several loans gives
    several rows. ``spread`` deals out frequent (key, date) pairs by salts, for sessions
    in which adaptive execution doesn't split them.
    """
    left = features.withColumnRenamed(date, FEATURE_DATE).withColumn(LABEL_DATE, plus_months(F.col(FEATURE_DATE), months))
    right = _outcomes(loans, key, date, months, threshold, carry)
    if spread:
        if null_safe:
            raise ValueError("frequent keys are spread in plain equi-joins alone")
        return spread_join(left, right.withColumnsRenamed({"_key": key, "_date": LABEL_DATE}), [key, LABEL_DATE]).select(
            *left.columns, "label", *carry
        )
    on = _equal(F.col(key), F.col("_key"), null_safe) & (F.col(LABEL_DATE) == F.col("_date"))
    return left.join(right, on, "inner").drop("_key", "_date")


def snapshot_coverage(
    features: DataFrame, loans: DataFrame, months: int = 6, date: str = "snapshot_date"
) -> DataFrame:
    """Each feature date with whether any outcome exists at the label date."""
    wanted = features.select(F.col(date).alias(FEATURE_DATE)).distinct()
    wanted = wanted.withColumn(LABEL_DATE, plus_months(F.col(FEATURE_DATE), months))
    have = loans.select(F.col(date).alias(LABEL_DATE)).distinct().withColumn("_have", F.lit(True))
    return wanted.join(have, LABEL_DATE, "left").select(
        FEATURE_DATE, LABEL_DATE, F.coalesce("_have", F.lit(False)).alias("has_label_date")
    )


def join_attributes(
    labelled: DataFrame,
    attributes: DataFrame,
    loans: DataFrame,
    columns: Sequence[str],
    months: int = 6,
    key: str = "Customer_ID",
    date: str = "snapshot_date",
    spread: bool = False,
) -> DataFrame:
    """Labelled feature rows with the attributes of the same key and dates.

    Both sides of this join stand for "one row per loan", so a key with k loans at
    the label date yields k times k rows. The attribute side is not blown up before
    the shuffle: it carries k as a number, and the copies are made after the join.
    """
    k = (
        loans.where(F.col("mob") == months)
        .groupBy(F.col(key).alias("_key"), F.col(date).alias("_date"))
        .agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    )
    dated = attributes.select(
        F.col(key),
        F.col(date).alias(FEATURE_DATE),
        plus_months(F.col(date), months).alias(LABEL_DATE),
        *columns,
    )
    side = dated.join(k, (F.col(key) == F.col("_key")) & (F.col(LABEL_DATE) == F.col("_date"))).drop("_key", "_date")
    joined = (spread_join if spread else DataFrame.join)(labelled, side, [key, FEATURE_DATE, LABEL_DATE], "inner")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copies"))).drop("_copy", "_copies")


def _row_keys(keys: Sequence[str], left: DataFrame, right: DataFrame, by_key_only: bool) -> list[str]:
    """The keys, and the row's number where both sides have it."""
    numbered = ROW in left.columns and ROW in right.columns and not by_key_only
    return [*keys, *([ROW] if numbered else [])]


def feature_label_join(features: DataFrame, labels: DataFrame, by_key_only: bool = False, spread: bool = False) -> DataFrame:
    """Each feature row with its own label.

    A key with k loans has k times k rows in either store. They are told apart by the
    row's number; with ``by_key_only`` each meets each, which gives k to the power of 4.
    """
    on = _row_keys(KEYS, features, labels, by_key_only)
    side = features.drop(ROW) if by_key_only else features
    return (spread_join if spread else DataFrame.join)(side, labels.select(*on, "label"), on, "inner")


def scored_join(labelled: DataFrame, predictions: DataFrame, by_key_only: bool = False, spread: bool = False) -> DataFrame:
    """Labelled rows with their own scores; with ``by_key_only`` all of the same key and feature date."""
    # Numbered rows are joined on all keys, as the stores are: bucketed alike, they join without a shuffle.
    numbered = ROW in labelled.columns and set(KEYS + (ROW,)) <= set(predictions.columns) and not by_key_only
    on = _row_keys(KEYS if numbered else ("Customer_ID", FEATURE_DATE), labelled, predictions, by_key_only)
    scores = predictions.select(*on, "prediction", "prediction_proba_1")
    return (spread_join if spread else DataFrame.join)(labelled, scores, on, "inner")


def in_date_range(df: DataFrame, date: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Both ends inclusive; a plain column comparison, so it reaches the Parquet scan."""
    out = df
    if start is not None:
        out = out.where(F.col(date) >= F.lit(start).cast(df.schema[date].dataType))
    if end is not None:
        out = out.where(F.col(date) <= F.lit(end).cast(df.schema[date].dataType))
    return out


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df


def exact_snapshot(df: DataFrame, date: str, value: str) -> DataFrame:
    return require_rows(in_date_range(df, date, value, value), f"no rows for snapshot date {value}")
