"""Session helpers: the shared scratch folder and a stable split plan."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new, unused path below the folder named in ``spark.checkpoint.dir``.

    Every executor must reach it, so a machine-local folder is made up only in
    local mode, where the driver is the one executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_roots.get(context.applicationId)
        if root is None:
            root = tempfile.mkdtemp(prefix="tallyline-", dir="/tmp")
            _local_roots[context.applicationId] = root
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def saved(df: DataFrame, purpose: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Cuts the lineage with files that outlive any executor.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, purpose: str) -> Iterator[DataFrame]:
    """As ``saved``, for a block: the table is removed at its end."""
    from tallyline.sinks.publish import discard

    spark, path = df.sparkSession, shared_folder(df.sparkSession, purpose)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        discard(spark, path)


def pin_split_plan(spark: SparkSession) -> None:
    """Make two scans of the same files cut them into the same splits.

    Spark sizes splits from the cores it has at that moment, and these change
    while a cluster grows or loses executors. A value already set is kept.
    """
    key = "spark.sql.files.minPartitionNum"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
