"""Bronze ingest of files as they arrive."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import month_label
from ..functions.text import CSV_NULLS, null_if_in
from ..operators.clean import coerce_dates
from ..sources.tables import MONTH, deliveries


def ingest_new_files(
    spark: SparkSession,
    columns: Sequence[str],
    raw_folder: str,
    table_path: str,
    checkpoint: str,
    date_col: str = "snapshot_date",
) -> StreamingQuery:
    """Take in all files not seen before, then stop.

    Each micro-batch is one delivery in a folder beside the table, named after the
    checkpoint and the batch number, so a batch that is run again replaces its own
    rows and nothing else. ``read_table`` reads the table and its deliveries. A later
    batch write of a month replaces the table's own rows of that month; deliveries stay.
    """
    raw = (
        spark.readStream.schema(", ".join(f"`{c}` string" for c in columns))
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(raw_folder)
    )
    cleaned = raw.select([null_if_in(F.col(f"`{c}`"), CSV_NULLS).alias(c) for c in columns])
    typed = coerce_dates(cleaned, [date_col]).withColumn(MONTH, month_label(F.col(date_col)))
    stream = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]

    def deliver(rows: DataFrame, number: int) -> None:
        folder = f"{deliveries(table_path)}/delivery={stream}-{number:010d}"
        rows.write.mode("overwrite").partitionBy(MONTH).parquet(folder)

    return (
        typed.writeStream.foreachBatch(deliver)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
