"""Numeric expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age classes, each closed on the right.
AGE_EDGES = (0, 25, 35, 45, 55, 100)
AGE_LABELS = ("18-25", "26-35", "36-45", "46-55", "56+")


def clip(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clip to [lo, hi]; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo))
    if hi is not None:
        out = F.least(out, F.lit(hi))
    return F.when(c.isNotNull(), out)


def log1p_filled(c: Column) -> Column:
    """log(1 + x) with missing taken as 0; x <= -1 gives NULL."""
    return F.log1p(F.coalesce(c, F.lit(0.0)))


def safe_ratio(num: Column, den: Column, add: float = 1.0) -> Column:
    """num / (den + add); a zero denominator gives NULL."""
    return F.try_divide(num, den + F.lit(add))


def ratio_or_zero(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def bin_right_closed(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval (edge[i], edge[i+1]] holding the value, else NULL."""
    out = F.when((c > edges[0]) & (c <= edges[1]), labels[0])
    for lo, hi, label in zip(edges[1:], edges[2:], labels[1:]):
        out = out.when((c > lo) & (c <= hi), label)
    return out


def histogram_bin(c: Column, edges: Sequence[float]) -> Column:
    """Index of the bin [edge[i], edge[i+1]); the last one is closed; outside is NULL."""
    index = sum(((c >= F.lit(e)).cast("int") for e in edges[1:-1]), F.lit(0))
    return F.when(c.between(F.lit(edges[0]), F.lit(edges[-1])), index)
