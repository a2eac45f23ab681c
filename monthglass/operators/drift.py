"""Distribution drift of features, scores and labels against a reference period.

The reference is described by two expressions on one frame: ``is_ref`` marks its
rows, ``window`` names the group a row is compared in (NULL: none). A row may be
both, as the first months are reference and window at once.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.dates import plus_months
from ..session import stage_table
from .features import ROW, numeric_columns, text_columns
from .running import BUCKET, add_bucket, add_running, known, sums_before, unfold, value_splits, with_ranges

# Columns that are no features, bin count, alert thresholds.
NOT_FEATURES = ("Customer_ID", ROW, "label", "prediction", "prediction_proba_0", "prediction_proba_1")
NOT_REPORTED = (
    "Customer_ID", ROW, "feature_snapshot_date", "label_snapshot_date",
    "prediction_timestamp", "model_name", "model_version",
)
BINS = 10
PSI_WARNING, PSI_CRITICAL, F1_DROP = 0.1, 0.25, 0.05

REF, WIN = "_ref", "_win"


@dataclass(frozen=True)
class Reference:
    """What is learned from the reference rows: a few numbers per feature."""

    rows: int
    edges: dict[str, list[float]]
    score_mean: float | None
    label_mean: float | None

    @property
    def features(self) -> list[str]:
        return list(self.edges)

    @property
    def bins(self) -> int:
        return max((len(e) for e in self.edges.values()), default=1) - 1


def _edges(lo: float, hi: float, bins: int) -> list[float]:
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return [float(x) for x in np.linspace(lo, hi, bins + 1)]


def fit_reference(
    reference: DataFrame,
    features: Sequence[str],
    score: str | None = None,
    label: str | None = None,
    bins: int = BINS,
) -> Reference:
    """Bin edges per feature and the mean score and label; a feature without any value is left out."""
    ends = [
        F.expr(f"{f}({known(c)}) AS {n}{i}")
        for i, c in enumerate(features)
        for n, f in (("lo", "min"), ("hi", "max"))
    ]
    mean = lambda c, name: (F.avg(c) if c else F.lit(None).cast("double")).alias(name)
    row = reference.agg(F.count(F.lit(1)).alias("n"), mean(score, "s"), mean(label, "l"), *ends).first()
    edges = {
        c: _edges(row[f"lo{i}"], row[f"hi{i}"], bins)
        for i, c in enumerate(features)
        if row[f"lo{i}"] is not None and np.isfinite([row[f"lo{i}"], row[f"hi{i}"]]).all()
    }
    return Reference(row.n, edges, row.s, row.l)


def mark(df: DataFrame, is_ref: Column, window: Column) -> DataFrame:
    return df.withColumns({REF: F.coalesce(is_ref, F.lit(False)).cast("int"), WIN: window})


def first_months(df: DataFrame, date: str, months: int = 3) -> Column:
    """Rows up to the first date plus ``months``, both ends included."""
    first = df.agg(F.min(date).cast("string")).first()[0]
    return F.col(date) <= plus_months(F.lit(first).cast(df.schema[date].dataType), months)


@dataclass(frozen=True)
class Cells:
    """All features of a marked frame unfolded, each value with the index of its range.

    ``rows`` is (ref, window, feature, range index, value). ``ranges`` counts them per
    feature, range and window: summed up in the map tasks, it is a small table. PSI
    and KS made from the same ``Cells`` share it: Spark reuses its exchange.
    """

    splits: dict[str, list[float]]
    rows: DataFrame
    ranges: DataFrame


def unfold_cells(marked: DataFrame, splits: dict[str, list[float]]) -> Cells:
    wide = with_ranges(marked, splits, [REF, WIN])
    rows = unfold(wide, {c: f"`{c}`" for c in splits}, [REF, WIN])
    return Cells(splits, rows, rows.groupBy("feature", BUCKET, WIN).agg(*_sizes()))


def _sizes() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.sum(REF).alias("n_ref")]


def with_edges(ref: Reference, splits: dict[str, list[float]]) -> dict[str, list[float]]:
    """The cut points and the bin edges, so that every range lies inside one bin."""
    return {c: sorted({*_closed(e), *splits.get(c, [])}) for c, e in ref.edges.items()}


def _closed(edges: Sequence[float]) -> list[float]:
    """Moving the last edge up by the smallest step closes the last bin on the right."""
    return [*edges[:-1], float(np.nextafter(edges[-1], np.inf))]


def bin_counts(ref: Reference, cells: Cells) -> DataFrame:
    """(feature, window, bin, n, n_ref): every value is counted, bin NULL is out of range.

    The ranges of ``cells`` must not straddle a bin edge, see ``with_edges``.
    """
    places = [
        (c, i + 1, bisect_right(_closed(e), low) - 1) for c, e in ref.edges.items() for i, low in enumerate(cells.splits[c])
    ]
    inside = [(c, i, b) for c, i, b in places if 0 <= b < ref.bins]
    # One row per cut point, made here.
    of_range = cells.ranges.sparkSession.createDataFrame(inside, f"feature string, {BUCKET} int, bin int")
    return (
        cells.ranges.join(F.broadcast(of_range), ["feature", BUCKET], "left")
        .groupBy("feature", WIN, "bin")
        .agg(F.sum("n").alias("n"), F.sum("n_ref").alias("n_ref"))
    )


def psi(marked: DataFrame, ref: Reference, cells: Cells | None = None) -> DataFrame:
    """(window, feature, psi): sum of (q - p) ln(q / p) over bins of the reference range.

    Shares are (count + 1) / (n + bins); values outside the range are in no bin but
    count in n, and empty bins take part.
    """
    if not ref.edges:
        return _no_scores(marked, "psi")
    return psi_of(bin_counts(ref, cells or unfold_cells(marked, with_edges(ref, {}))), ref.bins)


def psi_of(counts: DataFrame, bins: int) -> DataFrame:
    """PSI from counts (feature, window, bin, n, n_ref); counts of the same cell add up."""
    sums = [f"sum({n}) AS {n}" for n in ("n", "n_ref")]
    sums += [f"sum(if(bin = {i}, {n}, 0)) AS {n}{i}" for n in ("n", "n_ref") for i in range(bins)]
    # One row per window and feature; the reference counts are spread over all windows.
    wide = counts.groupBy(WIN, "feature").agg(*map(F.expr, sums))
    shares = [(f"((r{i} + 1) / cast(r + {bins} AS double))", f"((n{i} + 1) / cast(n + {bins} AS double))") for i in range(bins)]
    total = " + ".join(f"({q} - {p}) * ln({q} / {p})" for p, q in shares)
    reference = [f"sum(n_ref{i}) OVER (PARTITION BY feature) AS r{i}" for i in ("", *range(bins))]
    return (
        wide.selectExpr("*", *reference)
        .where(F.col(WIN).isNotNull())
        .selectExpr(f"{WIN} AS window", "feature", f"{total} AS psi")
    )


def _no_scores(marked: DataFrame, name: str) -> DataFrame:
    empty = marked.select(F.col(WIN).alias("window"), F.lit("").alias("feature"), F.lit(0.0).alias(name))
    return empty.where(F.lit(False))


def ks(marked: DataFrame, ref: Reference, cells: Cells | None = None) -> DataFrame:
    """(window, feature, ks): two-sample Kolmogorov-Smirnov distance of each window to the reference."""
    return ks_samples(marked, ref, cells).select("window", "feature", "ks")


def ks_samples(marked: DataFrame, ref: Reference, cells: Cells | None = None) -> DataFrame:
    """(window, feature, ks, n_reference, n_current): the distance, and how many values each side has.

    Between two neighbouring values of a window its distribution function is flat
    while the reference's only grows, so the largest distance is found at a value of
    the window or just before it. The reference curve is therefore needed only at
    the windows' own values: it is summed up once along (feature, value) for all
    windows together, instead of once per window. Both curves are window sums inside
    a value range plus the counts of the earlier ranges.
    """
    if not ref.edges:
        none = F.lit(0).cast("long")
        return _no_scores(marked, "ks").withColumns({"n_reference": none, "n_current": none})
    cells = cells or unfold_cells(marked, {c: [] for c in ref.features} | value_splits(marked, ref.features))
    by_value = cells.rows.groupBy("feature", BUCKET, "value", WIN).agg(*_sizes())
    return ks_of(by_value, cells.ranges)


def ks_of(by_value: DataFrame, by_range: DataFrame) -> DataFrame:
    """KS from counts (n, n_ref) by (feature, range, value, window), and by (feature, range, window)."""
    along_ranges = W.partitionBy("feature").orderBy(BUCKET).rangeBetween(W.unboundedPreceding, -1)
    offsets = (
        by_range.select(
            "feature",
            BUCKET,
            WIN,
            *sums_before(["feature", WIN], ["n"]),
            F.sum("n").over(W.partitionBy("feature", WIN)).alias("n_total"),
            F.coalesce(F.sum("n_ref").over(along_ranges), F.lit(0)).alias("ref_before"),
            F.sum("n_ref").over(W.partitionBy("feature")).alias("ref_total"),
        ).where(F.col(WIN).isNotNull())
    )
    along_values = W.partitionBy("feature", BUCKET).orderBy("value").rangeBetween(W.unboundedPreceding, 0)
    at_value = W.partitionBy("feature", BUCKET, "value")
    counts = (
        by_value.withColumns({"ref_run": F.sum("n_ref").over(along_values), "ref_here": F.sum("n_ref").over(at_value)})
        .where(F.col(WIN).isNotNull())
    )
    curves = add_running(counts, offsets, ["feature", WIN], "value", ["n"])
    r, c = F.col("ref_before") + F.col("ref_run"), F.col("n_run")
    rt, ct = F.col("ref_total").cast("double"), F.col("n_total").cast("double")
    at = F.abs(r.cast("double") / rt - c.cast("double") / ct)
    just_before = F.abs((r - F.col("ref_here")).cast("double") / rt - (c - F.col("n")).cast("double") / ct)
    return (
        curves.groupBy(WIN, "feature")
        .agg(
            F.max(F.greatest(at, just_before)).alias("ks"),
            F.max("ref_total").alias("n_reference"),
            F.max("n_total").alias("n_current"),
        )
        .withColumnRenamed(WIN, "window")
    )


def _shared_cells(marked: DataFrame, ref: Reference, splits: dict[str, list[float]] | None = None) -> Cells | None:
    """For PSI and KS together; None without any feature."""
    if not ref.edges:
        return None
    return unfold_cells(marked, with_edges(ref, value_splits(marked, ref.features) if splits is None else splits))


def mean_drift(marked: DataFrame, ref: Reference, score: str | None, label: str | None, date: str) -> DataFrame:
    """Per window: first date, row counts and the distance of mean score and label rate."""

    def gap(column: str | None, base: float | None) -> Column:
        return F.abs(F.avg(column) - F.lit(base)) if column and base is not None else F.lit(None).cast("double")

    return (
        marked.where(F.col(WIN).isNotNull())
        .groupBy(F.col(WIN).alias("window"))
        .agg(
            F.min(date).alias("snapshot_date"),
            F.lit(ref.rows).cast("bigint").alias("reference_sample_count"),
            F.count(F.lit(1)).alias("current_sample_count"),
            gap(score, ref.score_mean).alias("prediction_drift"),
            gap(label, ref.label_mean).alias("label_drift"),
        )
    )


def per_window(scores: DataFrame, name: str) -> DataFrame:
    return scores.groupBy("window").agg(
        F.avg(name).alias(f"mean_{name}"),
        F.max(name).alias(f"max_{name}"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("feature", name)))).alias(f"{name}_scores"),
    )


def stability_over_time(
    df: DataFrame,
    date: str,
    features: Sequence[str] | None = None,
    score: str | None = "prediction_proba_1",
    label: str | None = "label",
    unit: str = "month",
    months: int = 3,
    splits: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Every calendar window against the first ``months`` months.

    The score maps hold one entry per feature, so their size is the number of columns.
    """
    if features is None:
        features = numeric_columns(df, NOT_FEATURES)
    early = first_months(df, date, months)
    marked = mark(df, early, F.date_trunc(unit, F.col(date)))
    # Filtered by date, not by mark, so that the filter reaches the scan.
    ref = fit_reference(df.where(early), features, score, label)
    base = mean_drift(marked, ref, score, label, date)
    cells = _shared_cells(marked, ref, splits)
    psi_part, ks_part = per_window(psi(marked, ref, cells), "psi"), per_window(ks(marked, ref, cells), "ks")
    return (
        base.join(psi_part, "window", "left")
        .join(ks_part, "window", "left")
        .select(
            "snapshot_date", "reference_sample_count", "current_sample_count",
            "mean_psi", "max_psi", "psi_scores", "mean_ks", "max_ks", "ks_scores",
            "prediction_drift", "label_drift",
        )
    )


def median_date(df: DataFrame, date: str, prob: float = 0.5) -> Column:
    """The exact ``prob`` quantile of a date column, as a literal of that column's type.

    The rows are read once, to count them per date; the wanted ranks are then looked
    for among the distinct dates, with running sums inside ranges of dates.
    """
    micros = F.unix_micros(F.col(date).cast("timestamp")).cast("double")
    dated = df.where(F.col(date).isNotNull())
    counts = stage_table(dated.groupBy(micros.alias("t")).agg(F.count(F.lit(1)).alias("n")), "dates")
    total = counts.agg(F.sum("n")).first()[0]
    t = None
    if total:
        at = prob * (total - 1)
        rows = add_bucket(counts.withColumn("_all", F.lit(0)), "t", value_splits(counts, ["t"])["t"])
        ranges = rows.groupBy("_all", BUCKET).agg(F.sum("n").alias("n"))
        offsets = ranges.select("_all", BUCKET, *sums_before(["_all"], ["n"]))
        upto = add_running(rows, offsets, ["_all"], "t", ["n"])
        first_to = lambda rank: F.min(F.when(F.col("n_run") > rank, F.col("t")))
        low, high = upto.agg(first_to(math.floor(at)), first_to(math.ceil(at))).first()
        t = low + (high - low) * (at - math.floor(at))
    return F.timestamp_micros(F.lit(None if t is None else int(t)).cast("bigint")).cast(df.schema[date].dataType)


def split_at_quantile(df: DataFrame, date: str, prob: float) -> tuple[DataFrame, DataFrame]:
    """Rows up to the date quantile, and the rows after it."""
    at = median_date(df, date, prob)
    return df.where(F.col(date) <= at), df.where(F.col(date) > at)


def missing_values_report(df: DataFrame, is_ref: Column, columns: Sequence[str]) -> DataFrame:
    """(column, missing_reference, missing_current, share of each side), one pass."""
    marked = df.withColumn(REF, F.coalesce(is_ref, F.lit(False)))
    counts = ["count_if(_ref) AS n_ref", "count_if(NOT _ref) AS n_cur"]
    rows = []
    for i, c in enumerate(columns):
        # NaN is missing too.
        gone = f"(`{c}` IS NULL OR isnan(`{c}`))" if df.schema[c].dataType.typeName() in ("double", "float") else f"`{c}` IS NULL"
        counts += [f"count_if(_ref AND {gone}) AS r{i}", f"count_if(NOT _ref AND {gone}) AS c{i}"]
        rows.append(
            f"named_struct('column_name', '{c}', 'missing_reference', r{i}, 'missing_current', c{i}, "
            f"'share_reference', try_divide(cast(r{i} AS double), n_ref), "
            f"'share_current', try_divide(cast(c{i} AS double), n_cur))"
        )
    return marked.agg(*map(F.expr, counts)).selectExpr(f"inline(array({', '.join(rows)}))")


def category_shares(df: DataFrame, is_ref: Column, columns: Sequence[str]) -> DataFrame:
    """(feature, category, n_reference, n_current, share change); NULL is a category of its own."""
    marked = df.withColumn(REF, F.coalesce(is_ref, F.lit(False)))
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("category")) for c in columns]
    counts = (
        marked.select(REF, F.inline(F.array(*cells)))
        .groupBy("feature", "category")
        .agg(F.count_if(REF).alias("n_reference"), F.count_if(~F.col(REF)).alias("n_current"))
    )
    # One row per feature, from the counts: the rows are read once.
    totals = counts.groupBy("feature").agg(F.sum("n_reference").alias("_r"), F.sum("n_current").alias("_c"))
    share = lambda c, n: F.try_divide(F.col(c).cast("double"), F.col(n).cast("double"))
    shared = counts.join(F.broadcast(totals), "feature").withColumns(
        {"share_reference": share("n_reference", "_r"), "share_current": share("n_current", "_c")}
    )
    return shared.withColumn("share_change", F.col("share_current") - F.col("share_reference")).drop("_r", "_c")


def categorical_psi(df: DataFrame, is_ref: Column, columns: Sequence[str]) -> DataFrame:
    """(feature, categories, psi) with categories as bins and the same +1 smoothing."""
    return categorical_psi_of(category_shares(df, is_ref, columns))


def categorical_psi_of(shares: DataFrame) -> DataFrame:
    """The same from counts (feature, n_reference, n_current), one row per category."""
    shares = shares.select("feature", "n_reference", "n_current")
    k, nr, nc = F.col("k"), F.col("nr"), F.col("nc")
    totals = shares.groupBy("feature").agg(
        F.count(F.lit(1)).alias("k"), F.sum("n_reference").alias("nr"), F.sum("n_current").alias("nc")
    )
    p = (F.col("n_reference") + 1).cast("double") / (nr + k).cast("double")
    q = (F.col("n_current") + 1).cast("double") / (nc + k).cast("double")
    # One row per feature: its size is the number of columns.
    return (
        shares.join(F.broadcast(totals), "feature")
        .groupBy("feature")
        .agg(F.max("k").alias("categories"), F.sum((q - p) * F.log(q / p)).alias("psi"))
    )


def drift_report(
    df: DataFrame,
    is_ref: Column,
    features: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    threshold: float = PSI_WARNING,
) -> DataFrame:
    """One row per feature: kind, PSI, KS (numeric only) and whether it drifted."""
    if features is None:
        features = numeric_columns(df, NOT_REPORTED)
    if categories is None:
        categories = text_columns(df, NOT_REPORTED)
    marked = mark(df, is_ref, F.when(F.coalesce(is_ref, F.lit(False)), None).otherwise(F.lit("current")))
    # Bounds, cut points, cells and categories read the stored columns, not the source.
    df = stage_table(marked.select(REF, WIN, *dict.fromkeys([*features, *categories])), "halves")
    marked, is_ref = df, F.col(REF) == 1
    ref = fit_reference(df.where(is_ref), features)
    cells = _shared_cells(marked, ref)
    numeric = psi(marked, ref, cells).join(ks(marked, ref, cells), ["window", "feature"]).select(
        "feature", F.lit("numeric").alias("kind"), "psi", "ks"
    )
    out = numeric
    if categories:
        by_category = categorical_psi(df, is_ref, categories).select(
            "feature", F.lit("categorical").alias("kind"), "psi", F.lit(None).cast("double").alias("ks")
        )
        out = numeric.unionByName(by_category)
    return out.withColumn("drifted", F.col("psi") >= threshold)


def drift_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if("drifted").alias("drifted_features"),
        F.avg(F.col("drifted").cast("double")).alias("drifted_share"),
    )


def target_shift(df: DataFrame, is_ref: Column, target: str) -> DataFrame:
    ref = F.coalesce(is_ref, F.lit(False))
    rates = df.agg(
        F.avg(F.when(ref, F.col(target))).alias("reference_rate"),
        F.avg(F.when(~ref, F.col(target))).alias("current_rate"),
    )
    return rates.withColumn("shift", F.abs(F.col("current_rate") - F.col("reference_rate")))


def psi_level(value: Column, warning: float = PSI_WARNING, critical: float = PSI_CRITICAL) -> Column:
    return F.when(value >= critical, "critical").when(value >= warning, "warning").otherwise("ok")


def drift_alerts(performance: DataFrame, stability: DataFrame, drop: float = F1_DROP) -> DataFrame:
    """Alert level per window; F1 is compared with the first window's F1."""
    first = performance.agg(F.min_by("f1", "snapshot_date").alias("_first")).first()[0]
    base = F.lit(first).cast("double")
    fallen = performance.select("snapshot_date", "f1", (base - F.col("f1")).alias("f1_drop"))
    joined = fallen.join(stability.select("snapshot_date", "mean_psi", "max_psi"), "snapshot_date")
    fell = F.coalesce(F.col("f1_drop") > drop, F.lit(False))
    return joined.withColumns(
        {
            "psi_alert": psi_level(F.col("max_psi")),
            "f1_alert": fell,
            "retrain": fell | F.coalesce(F.col("max_psi") >= PSI_CRITICAL, F.lit(False)),
        }
    )
