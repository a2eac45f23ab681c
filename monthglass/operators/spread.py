"""Equi-joins whose frequent keys are spread over all tasks, whatever the session's settings.

The frequent keys of the left side are looked for in one pass (`freqItems` finds every key
above the share, and at most one over the share of them). Only their rows get a salt, and
only their partners on the right are copied, once per salt; all other rows are joined as
they are. A row meets the same partners as before, once each.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Salts per shuffle partition: with several, a partition's share of a hot key is even.
SALTS = 16


def frequent_keys(df: DataFrame, keys: Sequence[str], share: float) -> list[int]:
    """Hashes of the key combinations that more than `share` of the rows have, and perhaps of some others."""
    hashed = df.select(F.xxhash64(*[F.col(f"`{k}`") for k in keys]).alias("h"))
    found = hashed.stat.freqItems(["h"], max(share, 1e-4)).first()
    return sorted(h for h in (found[0] or []) if h is not None) if found else []


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", share: float | None = None, salts: int | None = None) -> DataFrame:
    """``left.join(right, on, how)`` for inner, left, semi and anti joins, with the keys of more than `share` of the left rows spread.

    Without a share, keys are frequent that alone would fill a quarter of a shuffle partition.
    A row's salt is the hash of its columns, so a task that is run again deals alike; rows
    equal in all columns stay together. Columns named like the salt are left as they are.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"a {how} join can't copy its right side")
    partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = frequent_keys(left, on, share or 1 / (4 * partitions))
    if not hot:
        return left.join(right, list(on), how)
    salts = salts or SALTS * partitions
    name = "_salt"
    while name in left.columns or name in right.columns:
        name = f"_{name}"

    def is_hot() -> Column:
        return F.xxhash64(*[F.col(f"`{k}`") for k in on]).isin(hot)

    draw = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int")
    salted = left.withColumn(name, F.when(is_hot(), draw).otherwise(F.lit(0)))
    every = F.when(is_hot(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = right.withColumn(name, F.explode(every))
    return salted.join(copied, [*on, name], how).drop(name)
