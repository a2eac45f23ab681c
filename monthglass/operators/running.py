"""Value ranges and running sums that never put a whole group into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import split_count

BUCKET = "_bucket"


def value_splits(df: DataFrame, columns: Sequence[str], n: int | None = None) -> dict[str, list[float]]:
    """Cut points that divide each column into ranges of about equal size.

    One sketch aggregate for all columns; the driver receives at most ``n`` numbers
    per column (as many as there are shuffle partitions, which is how the cluster is
    told of the data's size). The cut points only balance the work, any choice gives
    the same results. Being plain numbers, they make every task, also one that is run
    again, cut alike.
    """
    if not columns:
        return {}
    n = n or split_count(df.sparkSession)
    probs = [i / n for i in range(1, n)]
    found = df.approxQuantile(list(columns), probs, 1.0 / (2 * n))
    return {c: sorted({float(x) for x in xs if math.isfinite(x)}) for c, xs in zip(columns, found)}


def add_bucket(df: DataFrame, column: str, splits: Sequence[float], into: str = BUCKET) -> DataFrame:
    """Index of the value range; NULL gets a range of its own."""
    return add_buckets(df, {column: splits}, {column: into})


def add_buckets(df: DataFrame, splits: dict[str, Sequence[float]], names: dict[str, str]) -> DataFrame:
    columns = [c for c in names if splits.get(c)]
    out = df
    if columns:
        cut = [[float("-inf"), *splits[c], float("inf")] for c in columns]
        out = Bucketizer(
            splitsArray=cut,
            inputCols=columns,
            outputCols=[f"{names[c]}_" for c in columns],
            handleInvalid="keep",
        ).transform(out)
    indexes = [
        f"coalesce(cast(`{b}_` AS int), -1) AS `{b}`" if c in columns else f"0 AS `{b}`" for c, b in names.items()
    ]
    return out.selectExpr(*[f"`{c}`" for c in df.columns], *indexes)


def known(column: str) -> str:
    """SQL text of a column as double, NaN taken as missing."""
    return f"nullif(cast(`{column}` AS double), double('NaN'))"


def range_of(column: str) -> str:
    return f"_b_{column}"


def with_ranges(df: DataFrame, splits: dict[str, Sequence[float]], keep: Sequence[str] = ()) -> DataFrame:
    """The columns of ``splits`` as doubles, each with the index of its value range, and ``keep``."""
    doubles = df.selectExpr(*keep, *[f"{known(c)} AS `{c}`" for c in splits])
    return add_buckets(doubles, splits, {c: range_of(c) for c in splits})


def unfold(wide: DataFrame, values: dict[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep, feature, bucket, value): one row per known cell; ``values`` are SQL texts per feature."""
    cells = ", ".join(
        f"named_struct('feature', '{c}', '{BUCKET}', `{range_of(c)}`, 'value', {text})" for c, text in values.items()
    )
    return wide.selectExpr(*keep, f"inline(array({cells}))").where("value IS NOT NULL")


def sums_before(by: Sequence[str], sums: Sequence[str], descending: bool = False) -> list[Column]:
    """``<s>_before``: for a table of one row per (by, bucket), the sum over all earlier buckets.

    The window over ``by`` sees at most as many rows as there are cut points.
    """
    order = F.col(BUCKET).desc() if descending else F.col(BUCKET).asc()
    earlier = W.partitionBy(*by).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return [F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in sums]


def add_running(
    counts: DataFrame, offsets: DataFrame, by: Sequence[str], value: str, sums: Sequence[str], descending: bool = False
) -> DataFrame:
    """Add ``<s>_run``: the sum over the group up to and including this value.

    ``counts`` holds one row per (by, bucket, value), ``offsets`` one per (by,
    bucket) with the ``<s>_before`` columns and any totals to carry along. Inside a
    bucket the sum is a window over (by, bucket), so no task sorts a whole group.
    """
    order = F.col(value).desc() if descending else F.col(value).asc()
    inside = W.partitionBy(*by, BUCKET).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    joined = counts.join(offsets, [*by, BUCKET])
    return joined.withColumns({f"{s}_run": F.col(f"{s}_before") + F.sum(s).over(inside) for s in sums})
