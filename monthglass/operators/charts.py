"""The tables behind the monitoring charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .drift import PSI_CRITICAL, PSI_WARNING

# The metrics each chart shows when they are present.
PERFORMANCE = ("accuracy", "precision", "recall", "f1", "roc_auc")
CONFUSION = ("accuracy", "precision", "recall", "f1")
STABILITY = ("mean_psi", "max_psi", "mean_ks", "max_ks", "prediction_drift", "label_drift")


def _long(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    present = [m for m in metrics if m in df.columns]
    return df.unpivot("snapshot_date", present, "metric", "value")


def performance_long(performance: DataFrame, metrics: Sequence[str] = PERFORMANCE) -> DataFrame:
    return _long(performance, metrics)


def _rates() -> list[Column]:
    return [
        (F.col("actual_default_rate") * 100).alias("actual_pct"),
        (F.col("predicted_default_rate") * 100).alias("predicted_pct"),
    ]


def rate_comparison(performance: DataFrame) -> DataFrame:
    return performance.select("snapshot_date", *_rates())


def stability_long(stability: DataFrame) -> DataFrame:
    """With the two threshold lines drawn on the PSI charts."""
    is_psi = F.col("metric").contains("psi")
    return _long(stability, STABILITY).withColumns(
        {"warning_line": F.when(is_psi, F.lit(PSI_WARNING)), "critical_line": F.when(is_psi, F.lit(PSI_CRITICAL))}
    )


def confusion_evolution(performance: DataFrame) -> DataFrame:
    return performance.select("snapshot_date", *[m for m in CONFUSION if m in performance.columns])


def sample_counts(performance: DataFrame) -> DataFrame:
    return performance.select("snapshot_date", "sample_count")


def dashboard(performance: DataFrame, stability: DataFrame) -> DataFrame:
    """One row per window: quality, rates, PSI, counts and prediction drift."""
    quality = [m for m in PERFORMANCE if m in performance.columns]
    drift = stability.select("snapshot_date", "mean_psi", "max_psi", "prediction_drift")
    return performance.select("snapshot_date", "sample_count", *quality, *_rates()).join(drift, "snapshot_date", "left")
