"""Session helpers: the shared folder for intermediate tables, and bounded driver-side results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BROADCAST_ROWS = 100_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session without that setting gets one of its own."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        sc.setCheckpointDir(configured or "file://" + tempfile.mkdtemp(prefix="keelson-shared-"))
    return sc.getCheckpointDir()


def bounded_collect(df: DataFrame, limit: int, what: str) -> list:
    """Collect a frame that must be small; fail, rather than cut it, when it is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, for tables written by one job and read by the next."""
    return f"{shared_folder(spark)}/tables/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """A frame used by several jobs, computed once and written as Parquet to the shared folder.

    Unlike cached blocks the files outlive lost executors, later plans start from them, and columns and filters are
    pushed into their scans. ``release`` removes them.
    """
    path = shared_path(df.sparkSession, name)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the files behind frames made by ``stored``; for frames whose last reader has finished."""
    for df in frames:
        for folder in {f.rsplit("/", 1)[0].split("/tables/")[0] + "/tables/" + f.split("/tables/")[1].split("/")[0]
                       for f in df.inputFiles() if "/tables/" in f}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that made them ends. For steps that store what they make, so none is read again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def materialized(df: DataFrame) -> DataFrame:
    """``stored`` under a default name."""
    return stored(df, "step")
