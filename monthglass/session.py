"""Session settings and the shared staging folder."""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings the joins and sinks rely on; all can be set on a live session."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # A hot key is split even when a later operator then needs one more shuffle.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def apart(spark: SparkSession) -> SparkSession:
    """A session with the same settings and catalog, for frames that are observed.

    Once a frame of a session was observed, that session can't be shipped to executors
    any more, which MLlib's learners do; so what is observed has a session of its own.
    """
    return SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())


#: Rows that a shuffle partition of a `roomy` session holds on average, and bytes that adaptive execution puts together in one task.
ROOM, TOGETHER = 1 << 19, 16 << 20


def roomy(spark: SparkSession, rows: int) -> SparkSession:
    """A session like this one for joins of so many rows, whose tasks stay as small however many these are.

    It has a shuffle partition for every ``ROOM`` rows, and no fewer than this session;
    adaptive execution puts small ones together and splits those of a frequent key.
    """
    own = apart(spark)
    own.conf.set("spark.sql.shuffle.partitions", max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // ROOM)))
    own.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", TOGETHER)
    return own


@functools.cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="monthglass-")


#: Lists that take down the staged paths of the `staged_files` blocks open in this context.
_OPEN: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("staged", default=())


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder the cluster names; without one, a local folder if the master is local too."""
    base = spark.conf.get(CHECKPOINT_KEY, None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        base = _test_folder()
    path = f"{base.rstrip('/')}/monthglass/{name}-{uuid.uuid4().hex}"
    for paths in _OPEN.get():
        paths.append(path)
    return path


@contextlib.contextmanager
def staged_files(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the files staged inside; for stages that write their results elsewhere.

    Blocks of other threads are apart; a thread started inside belongs to the block if
    it runs in a copy of this context.
    """
    paths: list[str] = []
    token = _OPEN.set((*_OPEN.get(), paths))
    try:
        yield
    finally:
        _OPEN.reset(token)
        for path in paths:
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Take down a folder of any file system that Spark knows; none is no error."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage of a frame that several later passes read, and survives the
    loss of executors; being columnar, each pass reads only the columns it needs.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def split_count(spark: SparkSession) -> int:
    """How many value ranges a per-group running sum is cut into."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
