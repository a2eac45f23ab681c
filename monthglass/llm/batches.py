"""What Python workers are given: the size of their batches, and where they find this package."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame

KEY, USUAL, SMALL = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", 4 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's batches cut to 4 MB unless the caller has set a size.

    A batch is held several times over, by the JVM and by each Python worker; a task may
    have several workers, and what they once needed mostly stays with them.
    """
    conf = df.sparkSession.conf
    if conf.get(KEY) == USUAL:
        conf.set(KEY, str(SMALL))
    # Workers of a local session started elsewhere import the package from here, too.
    root, env = str(Path(__file__).resolve().parents[2]), df.sparkSession.sparkContext.environment
    paths = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df
