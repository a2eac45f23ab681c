"""Feature, label, prediction, metric and model stores."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import remove

REGISTRY_SCHEMA = (
    "model_name string, version string, timestamp string, primary_metric string, "
    "metrics map<string,double>, model_path string"
)


def _table_name(path: str) -> str:
    return f"monthglass_{hashlib.sha1(path.rstrip('/').encode()).hexdigest()[:16]}"


def _note(path: str) -> str:
    """Where a store's buckets are written down, beside its files."""
    return f"{path.rstrip('/')}.buckets"


def write_store(df: DataFrame, path: str, buckets: int | None = None, keys: Sequence[str] = ()) -> None:
    """Parquet; with ``buckets`` dealt out and sorted by ``keys``, so that stores of as many buckets join without a shuffle.

    That takes one shuffle here, and gives one file a bucket: a bucket is read by one task.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {_table_name(path)}")
    remove(spark, _note(path))
    if not buckets:
        df.write.mode("overwrite").parquet(path)
        return
    remove(spark, path)
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    writer = dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).saveAsTable(_table_name(path))
    note = json.dumps({"buckets": buckets, "keys": list(keys), "schema": df.schema.json()})
    spark.createDataFrame([(note,)], "note string").coalesce(1).write.mode("overwrite").text(_note(path))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """The store's rows; a bucketed one is made known to the session's catalog first."""
    at = spark._jvm.org.apache.hadoop.fs.Path(_note(path))
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.read.parquet(path)
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        note = json.loads(spark.read.text(_note(path)).first()[0])
        keys = ", ".join(f"`{k}`" for k in note["keys"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(note["schema"])))
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {note['buckets']} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def csv_ready(df: DataFrame) -> DataFrame:
    """CSV cells cannot hold maps, arrays or structs: write those as JSON text."""
    nested = (T.MapType, T.ArrayType, T.StructType)
    return df.select(
        [
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv(df: DataFrame, path: str) -> None:
    csv_ready(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .csv(path)
    )


def write_predictions(df: DataFrame, path: str, buckets: int | None = None, keys: Sequence[str] = ()) -> None:
    """Parquet for programs and CSV for people; the CSV is made from the stored Parquet."""
    write_store(df, f"{path}/parquet", buckets, keys)
    write_csv(df.sparkSession.read.parquet(f"{path}/parquet"), f"{path}/csv")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    return read_store(spark, f"{path}/parquet")


def save_model(
    spark: SparkSession,
    model: PipelineModel,
    folder: str,
    model_name: str,
    timestamp: str,
    metrics: dict[str, float],
    primary_metric: str = "roc_auc",
) -> str:
    """Store a fitted model under its version and add one row to the registry table."""
    version = f"v_{timestamp}"
    path = f"{folder}/models/{version}_{model_name}"
    model.write().overwrite().save(path)
    row = (model_name, version, timestamp, primary_metric, metrics, path)
    spark.createDataFrame([row], REGISTRY_SCHEMA).write.mode("append").parquet(f"{folder}/registry")
    return path


def read_registry(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{folder}/registry")


def load_model(spark: SparkSession, folder: str, path: str | None = None) -> tuple[PipelineModel, dict]:
    """The model at ``path``, or the one saved last, with its registry row."""
    rows = read_registry(spark, folder)
    if path is not None:
        rows = rows.where(F.col("model_path") == path)
    latest = rows.orderBy(F.desc("timestamp"), "model_name").first()
    if latest is None:
        raise FileNotFoundError(f"no saved model in {folder}")
    return PipelineModel.load(latest["model_path"]), latest.asDict(recursive=True)
