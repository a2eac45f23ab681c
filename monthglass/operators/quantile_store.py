"""Exact quantiles from stored monthly summaries and one narrow read.

A store holds, per month and column, a KLL sketch and the exact number of values in each
of a fixed set of ranges. Both merge over months, the counts by adding; a month that is
added again is replaced. The counts tell which range holds a wanted rank and how many
values lie below it, so an exact quantile needs the values of that range alone, which a
filter on the column picks out in the scan. The sketches give estimates without any read.

Cut points come from the sketch of the rows that the store is started with. They only
balance the work: with a shifted distribution ranges get larger, never the result wrong.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_label
from ..session import stage_table
from .drift_store import MONTH, in_months
from .quantiles import _range_sizes, _ranks, _values_at
from .running import BUCKET, known, unfold, with_ranges

#: Ranges per column.
RANGES = 256


@dataclass(frozen=True)
class QuantileStore:
    spark: SparkSession
    path: str

    def splits(self) -> dict[str, list[float]]:
        return json.loads(self.spark.read.parquet(f"{self.path}/cuts").first().cuts)

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{table}")

    def write(self, df: DataFrame, table: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(f"{self.path}/{table}")


def _sketch(column: str) -> str:
    return f"kll_sketch_agg_double({known(column)})"


def start(spark: SparkSession, path: str, df: DataFrame, columns: Sequence[str], ranges: int = RANGES) -> QuantileStore:
    """A new store with cut points from the rows of ``df``; it holds no month yet."""
    probs = ", ".join(f"{i / ranges}D" for i in range(ranges + 1))
    found = df.agg(*[F.expr(_sketch(c)).alias(f"s{i}") for i, c in enumerate(columns)], *[F.expr(f"count({known(c)})").alias(f"n{i}") for i, c in enumerate(columns)])
    points = [F.when(F.col(f"n{i}") > 0, F.expr(f"kll_sketch_get_quantile_double(s{i}, array({probs}))")).alias(f"q{i}") for i in range(len(columns))]
    row = found.select(*points).first()
    cuts = {}
    for i, c in enumerate(columns):
        at = {x for x in row[f"q{i}"] or () if math.isfinite(x)}
        # A cut also just above each point keeps a very frequent value in a range of its own.
        cuts[c] = sorted(at | {math.nextafter(x, math.inf) for x in at})
    spark.createDataFrame([(json.dumps(cuts),)], "cuts string").write.mode("overwrite").parquet(f"{path}/cuts")
    return QuantileStore(spark, path)


def add(store: QuantileStore, df: DataFrame, date: str, first: str, last: str | None = None) -> None:
    """Summarise the rows of the months from ``first`` to ``last`` and replace what the store has of them."""
    splits = store.splits()
    rows = df.where(in_months(F.col(date), first, last or first)).select(month_label(F.col(date)).alias(MONTH), *splits)
    rows = stage_table(rows, "months")
    counts = unfold(with_ranges(rows, splits, [MONTH]), {c: f"`{c}`" for c in splits}, [MONTH])
    store.write(counts.groupBy(MONTH, "feature", BUCKET).agg(F.count(F.lit(1)).alias("n")), "counts")
    sketched = rows.groupBy(MONTH).agg(*[F.expr(_sketch(c)).alias(f"s{i}") for i, c in enumerate(splits)])
    cells = ", ".join(f"named_struct('feature', '{c}', 'sketch', s{i})" for i, c in enumerate(splits))
    store.write(sketched.selectExpr(MONTH, f"inline(array({cells}))"), "sketches")


def estimates(store: QuantileStore, probs: Sequence[float]) -> DataFrame:
    """(feature, n, quantiles) of all months from their merged sketches; no row is read."""
    merged = store.read("sketches").groupBy("feature").agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
    sized = merged.withColumn("n", F.expr("kll_sketch_get_n_double(sketch)")).where("n > 0")
    listed = ", ".join(f"{float(p)}D" for p in probs)
    return sized.selectExpr("feature", "n", f"kll_sketch_get_quantile_double(sketch, array({listed})) AS quantiles")


def _counted(store: QuantileStore) -> dict[str, dict[int, int]]:
    """Per column the number of values of each range, over all months: a few hundred numbers a column."""
    out: dict[str, dict[int, int]] = {c: {} for c in store.splits()}
    for r in store.read("counts").groupBy("feature", BUCKET).agg(F.sum("n").alias("n")).collect():
        out[r.feature][r[BUCKET]] = r.n
    return out


def in_ranges(column: str, splits: Sequence[float], ranges: Sequence[int]):
    """A condition on the column that holds for the values of these ranges, as bounds that reach a scan."""
    parts = []
    for b in ranges:
        low, high = F.lit(True), F.lit(True)
        if b > 0:
            low = F.col(column) >= splits[b - 1]
        if b < len(splits):
            high = F.col(column) < splits[b]
        parts.append(low & high if 0 < b < len(splits) else (low if b > 0 else high))
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def stored_quantiles(store: QuantileStore, df: DataFrame, probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolation quantiles of each column over all months; ``df`` must hold the rows that were added.

    Of each column only the values of the ranges with wanted ranks are read.
    """
    splits, out = store.splits(), {}
    for c, counts in _counted(store).items():
        total = sum(counts.values())
        if not total:
            out[c] = [None] * len(probs)
            continue
        wanted = {r for q in probs for r in _ranks(q, total)}
        below, place = 0, {}
        for b in sorted(counts):
            for r in wanted:
                if below <= r < below + counts[b]:
                    place[r] = b
            below += counts[b]
        kept = sorted(set(place.values()))
        # Ranks among the values that are read.
        skipped = {b: sum(n for x, n in counts.items() if x < b and x not in kept) for b in kept}
        sub = df.where(in_ranges(c, splits[c], kept)).select(c)
        among = {r: r - skipped[place[r]] for r in wanted}
        ranges, _ = _range_sizes(sub, {c: [0.5]})
        values = _values_at(ranges, {c: set(among.values())})
        ends = [(*(values[c, among[r]] for r in _ranks(q, total)), q * (total - 1) - math.floor(q * (total - 1))) for q in probs]
        out[c] = [low + (high - low) * weight for low, high, weight in ends]
    return out
