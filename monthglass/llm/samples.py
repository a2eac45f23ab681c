"""Training samples of whole documents within a bound of bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..session import stage_table


def whole_bags(bags: DataFrame, largest: int, total: int) -> list[Row]:
    """Rows of ``bags(h, bag, ...)`` in the order of h, as many as have `total` bytes together; none is cut.

    A row of more than `largest` bytes is passed over. The caller bounds the number of rows.
    """
    held = stage_table(bags.withColumn("size", F.octet_length("bag")), "bags").where(F.col("size") <= largest)
    last, used = None, 0
    for r in held.select("h", "size").orderBy("h", "size").collect():
        used += r.size
        if used > total:
            break
        last = r.h
    return [] if last is None else held.where(F.col("h") <= last).collect()
