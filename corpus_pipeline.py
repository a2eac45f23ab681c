"""Documents to a training mix in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns rows
with the columns of ``documents``; the last one adds ``copy``. Nulls, empty texts,
repeated rows and empty tables pass through as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthglass.llm import leaks, minhash, mixing, quality, windows
from monthglass.plans.registry import query
from monthglass.session import remove, staged_files, staging_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cascade."""
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of three-line windows; n_chars follows the text. Documents that lose all their lines go."""
    cut = windows.drop_repeated_windows(docs).where("n_removed = 0 OR n_removed < n_lines")
    changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.withColumn("n_chars", changed).select(docs.columns)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8 or more."""
    return minhash.keep_one(docs, words=5, percent=80)


def leak_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return leaks.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; ``copy`` numbers the copies from 1."""
    return mixing.copies(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", leak_stage),
    ("mixing", mix_stage),
]

#: The walks, the bands and the rounding are random functions that SQL doesn't have; the
#: result is tested stage by stage against brute force.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage is stored before the next one reads it; what it needed is removed once it is stored."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = staging_path(spark, name)
        with staged_files(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
