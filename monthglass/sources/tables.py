"""Delimited files in, month-partitioned Parquet in and out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_label
from ..functions.text import CSV_NULLS, null_if_in
from ..session import remove

MONTH = "year_month"


def read_raw(
    spark: SparkSession,
    path: str,
    nulls: Sequence[str] = CSV_NULLS,
    multi_line: bool = False,
    columns: Sequence[str] | None = None,
    line: str | None = None,
) -> DataFrame:
    """CSV with a header, every column as text, the usual "missing" words as NULL.

    Every file's header is compared with ``columns``, or with the first file's header
    where none are given; a file whose columns differ in name or order fails the job.
    Quotes inside a quoted cell are doubled. ``multi_line`` allows line breaks in
    cells but stops Spark from splitting a file, so keep it off for large files.

    A line with too few cells is filled up with NULL and one with too many is cut, unless
    ``line`` names a column: it then holds the text of each such line, and NULL for the others.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )
    if line:
        columns = columns or reader.csv(path).columns
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", line)
    if columns:
        reader = reader.schema(", ".join(f"`{c}` string" for c in [*columns, *([line] if line else [])]))
    raw = reader.csv(path)
    return raw.select([F.col(f"`{c}`") if c == line else null_if_in(F.col(f"`{c}`"), nulls).alias(c) for c in raw.columns])


def write_monthly(df: DataFrame, path: str, date_col: str = "snapshot_date") -> None:
    """One folder per calendar month; only the months present in ``df`` are replaced.

    The rebalance hint lets adaptive execution cut a hot month into several files
    and merge the small ones. Without the date column the table is one plain folder.
    """
    if date_col not in df.columns:
        df.write.mode("overwrite").parquet(path)
        return
    (
        df.withColumn(MONTH, month_label(F.col(date_col)))
        .hint("rebalance", MONTH)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def write_rejects(df: DataFrame | None, spark: SparkSession, path: str, date_col: str = "snapshot_date") -> None:
    """The rows that cleaning removed, one folder per month, in place of all earlier ones; None: there are none."""
    remove(spark, path)
    if df is not None:
        write_monthly(df, path, date_col)


def deliveries(path: str) -> str:
    """Folder beside the table for rows that arrive by stream, one subfolder per delivery."""
    return f"{path.rstrip('/')}.deliveries"


def _exists(spark: SparkSession, pattern: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return found is not None and len(found) > 0


def _all_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table's own rows and those of its deliveries, with the month where there is one."""
    arrived = f"{deliveries(path)}/*"
    if not _exists(spark, arrived):
        return spark.read.parquet(path)
    late = spark.read.option("basePath", deliveries(path)).parquet(arrived).drop("delivery")
    if not _exists(spark, path):
        return late
    return spark.read.parquet(path).unionByName(late, allowMissingColumns=True)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All months, without the partition column; streamed deliveries included."""
    return _all_rows(spark, path).drop(MONTH)


def read_month(spark: SparkSession, path: str, month: str) -> DataFrame:
    """One month (``yyyy-MM``), reading that folder only; an absent month is an error."""
    rows = _all_rows(spark, path).where(F.col(MONTH) == month).drop(MONTH)
    if rows.isEmpty():
        raise ValueError(f"no partition {month} in {path}")
    return rows
