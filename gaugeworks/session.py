"""Session helpers: zone pinning, checkpoint folder and the job's settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

JOB_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def pin_utc(spark: SparkSession) -> SparkSession:
    """All wall-clock arithmetic of the package assumes a UTC session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a scratch folder only on local masters."""
    folder, current = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir()
    if current and (not folder or folder.rstrip("/") in current):
        return current
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="gaugeworks-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are in the shared folder, executors may go."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a compressed Parquet table in the shared folder: later reads take only the columns they use."""
    folder = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if (held := _SCRATCH.get()) is not None:
        held.append(folder)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_SCRATCH: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that :func:`written` makes inside the block are deleted at its end.

    For jobs that write their result inside the block; a frame taken out of it cannot be read.
    """
    token = _SCRATCH.set([])
    try:
        yield
    finally:
        for folder in _SCRATCH.get():
            delete_folder(spark, folder)
        _SCRATCH.reset(token)
