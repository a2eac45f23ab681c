"""Drift against a fixed reference, kept up month by month.

A store holds what is learned from the reference once (bin edges, value ranges, its counts
by value, mean score and label), and per month the counts of every bin, the sums behind
the means, and the KS distances. A month's rows are read when the month is added, and
never again: bin counts and sums of months merge by adding, and adding a month again
replaces it. The table of all months reads the stored numbers alone.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_label, plus_months
from ..session import stage_table
from .drift import (
    BUCKET,
    NOT_FEATURES,
    REF,
    WIN,
    Reference,
    bin_counts,
    first_months,
    fit_reference,
    ks_of,
    mark,
    per_window,
    psi_of,
    unfold_cells,
    with_edges,
)
from .features import numeric_columns
from .running import value_splits

MONTH = "month"


@dataclass(frozen=True)
class DriftStore:
    """A folder; see ``start``, ``add`` and ``stability``."""

    spark: SparkSession
    path: str

    def _fixed(self) -> tuple[Reference, dict]:
        row = self.spark.read.parquet(f"{self.path}/reference").first()
        kept = json.loads(row.fixed)
        return Reference(**kept.pop("reference")), kept

    def _write(self, df: DataFrame, table: str) -> None:
        """One folder per month; only the months present are replaced."""
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(f"{self.path}/{table}")

    def _read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}")


def start(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    date: str,
    features: Sequence[str] | None = None,
    score: str | None = "prediction_proba_1",
    label: str | None = "label",
    months: int = 3,
) -> DriftStore:
    """A new store whose reference are the rows of the first ``months`` months of ``df``, both ends included."""
    store = DriftStore(spark, path)
    features = numeric_columns(df, NOT_FEATURES) if features is None else list(features)
    first = df.agg(F.min(date).cast("string")).first()[0]
    rows = df.where(first_months(df, date, months))
    ref = fit_reference(rows, features, score, label)
    splits = with_edges(ref, value_splits(rows, ref.features))
    fixed = {"reference": asdict(ref), "splits": splits, "first": first, "date": date, "score": score, "label": label, "months": months}
    spark.createDataFrame([(json.dumps(fixed),)], "fixed string").write.mode("overwrite").parquet(f"{path}/reference")
    if not ref.edges:
        return store
    by_value = unfold_cells(mark(rows, F.lit(True), F.lit(None).cast("string")), splits).rows
    counts = by_value.groupBy("feature", BUCKET, "value").agg(F.count(F.lit(1)).alias("n_ref"))
    counts.write.mode("overwrite").parquet(f"{path}/reference_values")
    return store


def open_store(spark: SparkSession, path: str) -> DriftStore:
    return DriftStore(spark, path)


def in_months(date: Column, first: str, last: str) -> Column:
    """Dates of the months from ``first`` to ``last`` (``yyyy-MM``), as bounds that reach a scan."""
    end = plus_months(F.lit(f"{last}-01").cast("timestamp"), 1)
    return (date >= F.lit(f"{first}-01").cast("timestamp")) & (date < end)


def add(store: DriftStore, df: DataFrame, first: str, last: str | None = None) -> None:
    """Read the rows of the months from ``first`` to ``last`` and replace what the store has of them."""
    ref, kept = store._fixed()
    date, splits = kept["date"], kept["splits"]
    columns = dict.fromkeys([date, *ref.features, *[c for c in (kept["score"], kept["label"]) if c]])
    rows = stage_table(df.where(in_months(F.col(date), first, last or first)).select(*columns), "months")
    marked = mark(rows, F.lit(False), month_label(F.col(date)))
    total = lambda c: [F.sum(c).cast("double"), F.count(c)] if c else [F.lit(None).cast("double"), F.lit(0).cast("long")]
    names = ["score_sum", "score_n", "label_sum", "label_n"]
    sums = marked.groupBy(F.col(WIN).alias(MONTH)).agg(
        F.min(date).alias("snapshot_date"),
        F.count(F.lit(1)).alias("n"),
        *[x.alias(n) for x, n in zip([*total(kept["score"]), *total(kept["label"])], names)],
    )
    store._write(sums, "sums")
    if not ref.edges:
        return
    cells = unfold_cells(marked, splits)
    by_value = cells.rows.groupBy("feature", BUCKET, "value", WIN).agg(F.count(F.lit(1)).alias("n"), F.sum(REF).alias("n_ref"))
    bins = bin_counts(ref, cells).select("feature", F.col(WIN).alias(MONTH), "bin", "n")
    store._write(bins, "bins")
    fixed = store._read("reference_values").select(
        "feature", BUCKET, "value", F.lit(None).cast("string").alias(WIN), F.col("n_ref").alias("n"), "n_ref"
    )
    both = by_value.unionByName(fixed)
    ranges = both.groupBy("feature", BUCKET, WIN).agg(F.sum("n").alias("n"), F.sum("n_ref").alias("n_ref"))
    found = ks_of(both, ranges).select(F.col("window").alias(MONTH), "feature", "ks", "n_current")
    store._write(found, "ks")


def stability(store: DriftStore) -> DataFrame:
    """The table of ``stability_over_time`` by month, from the stored numbers."""
    ref, kept = store._fixed()
    gap = lambda c, base: (
        F.abs(F.try_divide(F.col(f"{c}_sum"), F.col(f"{c}_n").cast("double")) - F.lit(base)) if base is not None else F.lit(None).cast("double")
    )
    base = store._read("sums").select(
        F.col(MONTH).alias("window"),
        "snapshot_date",
        F.lit(ref.rows).cast("bigint").alias("reference_sample_count"),
        F.col("n").alias("current_sample_count"),
        gap("score", ref.score_mean).alias("prediction_drift"),
        gap("label", ref.label_mean).alias("label_drift"),
    )
    if ref.edges:
        psi = psi_of(_all_bins(store, ref, kept["splits"]), ref.bins)
        ks = store._read("ks").select(F.col(MONTH).alias("window"), "feature", "ks")
    else:
        none = base.select("window", F.lit("").alias("feature"), F.lit(0.0).alias("psi"), F.lit(0.0).alias("ks")).where(F.lit(False))
        psi, ks = none.drop("ks"), none.drop("psi")
    joined = base.join(per_window(psi, "psi"), "window", "left").join(per_window(ks, "ks"), "window", "left")
    return joined.select(
        "snapshot_date", "reference_sample_count", "current_sample_count",
        "mean_psi", "max_psi", "psi_scores", "mean_ks", "max_ks", "ks_scores",
        "prediction_drift", "label_drift",
    )


def _all_bins(store: DriftStore, ref: Reference, splits: dict[str, list[float]]) -> DataFrame:
    """Bin counts of all months, and of the reference, which is in no window."""
    months = store._read("bins").select("feature", F.col(MONTH).alias(WIN), "bin", "n", F.lit(0).cast("long").alias("n_ref"))
    rows = store._read("reference_values").select(
        "feature", BUCKET, F.lit(None).cast("string").alias(WIN), F.col("n_ref").alias("n"), "n_ref"
    )
    ranges = rows.groupBy("feature", BUCKET, WIN).agg(F.sum("n").alias("n"), F.sum("n_ref").alias("n_ref"))
    return months.unionByName(bin_counts(ref, _Counted(splits, ranges)))


@dataclass(frozen=True)
class _Counted:
    splits: dict[str, list[float]]
    ranges: DataFrame
