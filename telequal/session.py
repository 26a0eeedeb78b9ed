"""Settings that are read from the running session, never assumed."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Most rows, and bytes of their files, that may be sent to every executor.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 << 20


def shuffle_width(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only in a session of one process (``local``, as in tests) is a temporary folder set where none is named.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="telequal-")
        sc.setCheckpointDir(folder)
    return folder


def _scratch_root(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/telequal-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table, in this application's part of the shared folder."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove the tables this application wrote for its own use; call it when their readers are done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    For frames that several fits read: columnar, so a fit on one column reads one column, and safe when
    executors are lost, unlike a cache of an expensive stage.
    """
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` for a broadcast join if it has few rows and bytes, else for an ordinary join.

    It is computed once, into a written table whose size is then known.
    """
    kept = durable(df)
    size = int(kept._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    if size > max_bytes or kept.count() > max_rows:
        return kept
    return F.broadcast(kept)


@contextmanager
def batches_of(spark: SparkSession, size: int):
    """Within it, jobs hand Python tasks Arrow batches of about ``size`` bytes; the session's own setting returns after."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, size)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
