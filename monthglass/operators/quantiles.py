"""Exact quantiles at any size, and the capping, filling and scaling built on them.

Each operator has a fit step, which returns a few plain numbers per column, and an
apply step, which puts those numbers into the plan as literals. The applied
expressions stay in one code-generated projection: no join, no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clip, safe_ratio
from .running import BUCKET, add_running, range_of, sums_before, unfold, value_splits, with_ranges


# Half-width, as a share of the rows, of the range cut out around a wanted quantile.
BRACKET = 0.0005


def order_statistics(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float]
) -> dict[str, list[tuple[float, float, float] | None]]:
    """(lower value, upper value, weight of the upper one) per column and quantile.

    NULL is ignored; a column without any value gives None. The built-in exact
    ``percentile`` gathers all value counts of a column in one task. Here the search
    is narrowed instead: (1) a sketch gives two cut points closely around each wanted
    quantile, (2) one aggregate counts the rows of each range so made, which tells
    the range holding each wanted rank, (3) these ranges are cut finely, and their
    values are counted and numbered inside the fine ranges. The cut points only steer
    the work; a bad one makes a range larger, never the result wrong. The driver sees
    a few numbers per column.
    """
    columns = list(columns)
    if not columns:
        return {}
    sizes, total = _range_sizes(df, {c: list(probs) for c in columns})
    ranks = {c: {r for q in probs if total[c] for r in _ranks(q, total[c])} for c in columns}
    values = _values_at(sizes, ranks)

    def pick(c: str, q: float) -> tuple[float, float, float] | None:
        if not total[c]:
            return None
        low, high = _ranks(q, total[c])
        return values[c, low], values[c, high], q * (total[c] - 1) - low

    return {c: [pick(c, q) for q in probs] for c in columns}


def _ranks(q: float, n: int) -> tuple[int, int]:
    return math.floor(q * (n - 1)), math.ceil(q * (n - 1))


@dataclass(frozen=True)
class _Ranges:
    """The columns with the index of their value range, and the rows per range."""

    wide: DataFrame
    rows: dict[str, dict[int, int]]

    def locate(self, column: str, rank: int) -> tuple[int, int]:
        """The range holding a rank, and the rank counted from the start of that range."""
        for b in sorted(self.rows[column]):
            if rank < self.rows[column][b]:
                return b, rank
            rank -= self.rows[column][b]
        raise IndexError(rank)


def _range_sizes(df: DataFrame, wanted: dict[str, list[float]]) -> tuple[_Ranges, dict[str, int]]:
    """Cut each column around its wanted quantiles and count the ranges."""
    near = sorted({min(1.0, max(0.0, q + d)) for qs in wanted.values() for q in qs for d in (-BRACKET, BRACKET)})
    found = df.approxQuantile(list(wanted), near, BRACKET / 2)
    splits: dict[str, list[float]] = {}
    for (c, qs), cuts in zip(wanted.items(), found):
        mine = {min(1.0, max(0.0, q + d)) for q in qs for d in (-BRACKET, BRACKET)}
        low = {float(x) for x, p in zip(cuts, near) if p in mine and math.isfinite(x)}
        # A cut also just above each point keeps a very frequent value in a range of its own.
        splits[c] = sorted(low | {math.nextafter(x, math.inf) for x in low})
    wide = with_ranges(df, splits)
    rows: dict[str, dict[int, int]] = {c: {} for c in wanted}
    cells = unfold(wide, {c: f"`{c}`" for c in wanted})
    for r in cells.groupBy("feature", BUCKET).agg(F.count(F.lit(1)).alias("n")).collect():
        rows[r.feature][r[BUCKET]] = r.n
    return _Ranges(wide, rows), {c: sum(n.values()) for c, n in rows.items()}


def _values_at(ranges: _Ranges, wanted: dict[str, set[int]]) -> dict[tuple[str, int], float]:
    """The value at each wanted rank of each column.

    Of each column the ranges that hold wanted ranks are kept, cut into finer ranges,
    and their values are counted and numbered inside those; counts of the earlier ones
    are added.
    """
    kept: dict[str, list[int]] = {}
    among: dict[tuple[str, int], int] = {}  # rank among the kept values -> rank among all
    for c, ranks in wanted.items():
        found = {r: ranges.locate(c, r) for r in sorted(ranks)}
        kept[c] = sorted({b for b, _ in found.values()})
        for r, (b, rest) in found.items():
            among[c, sum(ranges.rows[c][x] for x in kept[c] if x < b) + rest] = r
    kept = {c: bs for c, bs in kept.items() if bs}
    if not kept:
        return {}
    # Values outside the kept ranges are NULL and take no part.
    cut = ranges.wide.selectExpr(
        *[f"if(`{range_of(c)}` IN ({', '.join(map(str, bs))}), `{c}`, NULL) AS `{c}`" for c, bs in kept.items()]
    )
    fine = with_ranges(cut, value_splits(cut, list(kept)))
    counts = unfold(fine, {c: f"`{c}`" for c in kept}).groupBy("feature", BUCKET, "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy("feature", BUCKET).agg(F.sum("n").alias("n"))
    numbered = add_running(counts, sizes.select("feature", BUCKET, *sums_before(["feature"], ["n"])), ["feature"], "value", ["n"])
    # A handful of rows made here: two ranks per column and quantile.
    ranks = cut.sparkSession.createDataFrame(list(among), "feature string, rank bigint")
    covers = (F.col("n_run") - F.col("n") <= F.col("rank")) & (F.col("rank") < F.col("n_run"))
    rows = numbered.join(F.broadcast(ranks), "feature").where(covers).collect()
    return {(r.feature, among[r.feature, r.rank]): r.value for r in rows}


def interpolate(found: tuple[float, float, float] | None, lo: float | None = None, hi: float | None = None) -> float | None:
    """The quantile; with bounds, that of the values clipped to them (clipping keeps the order)."""
    if found is None:
        return None
    low, high, weight = found
    ends = []
    for x in (low, high):
        x = x if lo is None else max(x, lo)
        ends.append(x if hi is None else min(x, hi))
    return ends[0] + (ends[1] - ends[0]) * weight


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles, exact at any size."""
    return {c: [interpolate(x) for x in xs] for c, xs in order_statistics(df, columns, probs).items()}


def sketch_quantiles(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], error: float = 0.001
) -> dict[str, list[float | None]]:
    """One-pass approximation; the values returned are elements of the data."""
    found = df.approxQuantile(list(columns), list(probs), error)
    return {c: (xs or [None] * len(probs)) for c, xs in zip(columns, found)}


def fit_caps(
    df: DataFrame,
    columns: Sequence[str],
    method: str = "quantile",
    low: float = 0.01,
    high: float = 0.95,
    factor: float = 1.5,
    sigmas: float = 3.0,
    exact: bool = True,
) -> dict[str, tuple[float | None, float | None]]:
    """Lower and upper bound per column: by quantiles, quartile distance or deviations."""
    columns = list(columns)
    quantiles = exact_quantiles if exact else sketch_quantiles
    if method == "quantile":
        return {c: (v[0], v[1]) for c, v in quantiles(df, columns, [low, high]).items()}
    if method == "iqr":
        found = quantiles(df, columns, [0.25, 0.75])
        return {
            c: (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
            for c, (q1, q3) in found.items()
        }
    if method == "zscore":
        row = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev))]).first()
        bounds = {}
        for c in columns:
            m, s = row[f"m_{c}"], row[f"s_{c}"]
            bounds[c] = (None, None) if m is None or s is None else (m - sigmas * s, m + sigmas * s)
        return bounds
    raise ValueError(f"unknown capping method {method!r}")


def apply_caps(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c).cast("double"), lo, hi) for c, (lo, hi) in bounds.items()})


def fit_caps_and_medians(
    df: DataFrame, capped: Sequence[str], filled: Sequence[str], low: float = 0.01, high: float = 0.95
) -> tuple[dict[str, tuple[float | None, float | None]], dict[str, float | None]]:
    """Quantile bounds, and the medians of the columns as they are after capping, from one fit."""
    columns = list(dict.fromkeys([*capped, *filled]))
    found = order_statistics(df, columns, [low, 0.5, high])
    caps = {c: (interpolate(found[c][0]), interpolate(found[c][2])) for c in capped}
    return caps, {c: interpolate(found[c][1], *caps.get(c, (None, None))) for c in filled}


def fit_fill(df: DataFrame, columns: Sequence[str], method: str = "median", constant: float = 0.0) -> dict[str, float | None]:
    """The number that replaces NULL in each column."""
    columns = list(columns)
    if method == "median":
        return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}
    if method == "mean":
        row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
        return {c: row[c] for c in columns}
    if method == "constant":
        return dict.fromkeys(columns, constant)
    raise ValueError(f"unknown fill method {method!r}")


def apply_fill(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """A column with no value at all keeps its NULLs."""
    return df.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.lit(v)) for c, v in values.items() if v is not None}
    )


def most_frequent(df: DataFrame, column: str):
    """The most frequent value, the smallest of equally frequent ones; NULL ignored."""
    row = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), column)
        .first()
    )
    return None if row is None else row[0]


def fit_scale(df: DataFrame, columns: Sequence[str], method: str = "standard") -> dict[str, tuple[float | None, float | None]]:
    """(centre, spread) per column: mean and population deviation, min and range, or median and quartile distance."""
    columns = list(columns)
    if method == "robust":
        found = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        return {c: (None, None) if q[1] is None else (q[1], q[2] - q[0]) for c, q in found.items()}
    if method == "standard":
        pairs = [(F.avg(c), F.stddev_pop(c)) for c in columns]
    elif method == "minmax":
        pairs = [(F.min(c), F.max(c) - F.min(c)) for c in columns]
    else:
        raise ValueError(f"unknown scaling method {method!r}")
    named = [x for i, (a, b) in enumerate(pairs) for x in (a.alias(f"a{i}"), b.alias(f"b{i}"))]
    row = df.agg(*named).first()
    return {c: (row[f"a{i}"], row[f"b{i}"]) for i, c in enumerate(columns)}


def apply_scale(df: DataFrame, fitted: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """(x - centre) / spread; a constant column becomes 0."""
    new = {}
    for c, (centre, spread) in fitted.items():
        if centre is not None:
            new[c] = safe_ratio(F.col(c) - F.lit(centre), F.lit(float(spread or 1.0)), add=0.0)
    return df.withColumns(new)
