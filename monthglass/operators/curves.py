"""ROC and precision-recall curves as small tables.

A curve has a point per distinct score. What is kept of it: the corners of its upper
convex hull, which no thinning may lose (a threshold that is best for any costs lies at
one), and the first point of each of a number of equal steps along the curve.

Hulls are built in two rounds: inside value ranges, so that no task holds a group's
whole curve, and of the corners left by those. Only points on the hull of their own range can be
on the hull of all.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .running import BUCKET, add_bucket, add_running, known, sums_before, value_splits

#: Steps along the curve, measured by (share of positives + share of negatives) / 2; the kept points' area is within about 0.001 of the whole curve's.
STEPS = 165


def upper_hull(points: Sequence[tuple[int, int]], origin: bool) -> list[int]:
    """Indexes of the corners of points (fp, tp) in the order of the curve; points on a straight edge are none.

    With ``origin`` the curve begins at (0, 0), which is no point itself.
    """
    kept: list[tuple[int, int, int]] = [(0, 0, -1)] if origin else []
    for k, (x, y) in enumerate(points):
        while len(kept) > 1:
            (x1, y1, _), (x2, y2, _) = kept[-2:]
            if (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1) < 0:
                break
            kept.pop()
        kept.append((x, y, k))
    return [k for *_, k in kept if k >= 0]


def _thin(steps: int, last: bool):
    """Of a run of the curve, in the order of falling scores: hull corners and the first point of each step."""

    def thin(part: pa.Table) -> pa.Table:
        part = part.sort_by([("threshold", "descending")])
        points = list(zip(part["fp"].to_pylist(), part["tp"].to_pylist()))
        corners = set(upper_hull(points, last))
        step = part["step"].to_pylist()
        keep = [k for k in range(len(points)) if k in corners or k == 0 or step[k] != step[k - 1]]
        out = part.take(pa.array(keep, pa.int64()))
        if last:
            mark = pa.array([k in corners for k in keep], pa.bool_())
            out = out.set_column(out.column_names.index("corner"), "corner", mark)
        return out

    return thin


def curve_points(df: DataFrame, y: str, score: str, by: Sequence[str] = (), steps: int = STEPS, splits: Sequence[float] | None = None) -> DataFrame:
    """(by, threshold, tp, fp, positives, negatives, tpr, fpr, precision, corner), rows scored at or above the threshold.

    At most `steps` + 1 points per group and the hull's corners. Rows without a score or
    group are left out; a group without positives or without negatives has rates of 0.
    """
    keys = list(by) or ["_all"]
    rows = (df if by else df.withColumn("_all", F.lit(0))).withColumn(score, F.expr(known(score)))
    for k in [*keys, score]:
        rows = rows.where(F.col(k).isNotNull())
    if splits is None:
        splits = value_splits(rows, [score])[score]
    positive = F.coalesce(F.col(y) == 1, F.lit(False))
    counts = add_bucket(rows, score, splits).groupBy(*keys, BUCKET, F.col(score).alias("threshold")).agg(
        F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg")
    )
    ranges = counts.groupBy(*keys, BUCKET).agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = [F.expr(f"sum({c}) over (partition by {', '.join(f'`{k}`' for k in keys)})").alias(n) for c, n in (("pos", "positives"), ("neg", "negatives"))]
    offsets = ranges.select(*keys, BUCKET, *sums_before(keys, ["pos", "neg"], descending=True), *totals)
    curve = add_running(counts, offsets, keys, "threshold", ["pos", "neg"], descending=True)
    tp, fp = F.col("pos_run"), F.col("neg_run")
    share = lambda c, n: F.coalesce(F.try_divide(c.cast("double"), F.col(n).cast("double")), F.lit(0.0))
    tpr, fpr = share(tp, "positives"), share(fp, "negatives")
    curve = curve.select(
        *keys,
        BUCKET,
        "threshold",
        tp.cast("long").alias("tp"),
        fp.cast("long").alias("fp"),
        F.col("positives").cast("long").alias("positives"),
        F.col("negatives").cast("long").alias("negatives"),
        F.floor((tpr + fpr) / 2 * steps).cast("int").alias("step"),
        F.lit(False).alias("corner"),
    )
    found = curve.groupBy(*keys, BUCKET).applyInArrow(_thin(steps, False), curve.schema)
    found = found.groupBy(*keys).applyInArrow(_thin(steps, True), curve.schema)
    tp, fp = F.col("tp"), F.col("fp")
    return found.select(
        *by,
        "threshold",
        "tp",
        "fp",
        "positives",
        "negatives",
        share(tp, "positives").alias("tpr"),
        share(fp, "negatives").alias("fpr"),
        (tp.cast("double") / (tp + fp).cast("double")).alias("precision"),
        "corner",
    )


def curve_area(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, area): the area under the kept points joined by straight lines, from (0, 0) to (1, 1)."""
    order = f"partition by {', '.join(by) if by else '0'} order by threshold desc"
    before = lambda c: F.coalesce(F.expr(f"lag({c}) over ({order})"), F.lit(0.0))
    sided = points.select(*by, "tpr", "fpr", before("tpr").alias("tpr0"), before("fpr").alias("fpr0"))
    return sided.groupBy(*by).agg(F.sum((F.col("fpr") - F.col("fpr0")) * (F.col("tpr") + F.col("tpr0")) / 2).alias("area"))
