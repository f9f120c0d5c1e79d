"""Folders that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting by which an execution's shuffle files go when it has ended (from Spark 4.1; without effect before), not when the driver collects garbage.
_DROPS = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _base(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under spark.checkpoint.dir; where a local session sets none (tests), under a temporary folder."""
    return f"{_base(spark).rstrip('/')}/{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is executed within leaves no shuffle files behind. For writes of frames that are not executed again."""
    before = spark.conf.get(_DROPS, "false")
    spark.conf.set(_DROPS, "true")
    try:
        yield
    finally:
        spark.conf.set(_DROPS, before)


def _stored(df: DataFrame, path: str) -> DataFrame:
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept(df: DataFrame) -> DataFrame:
    """df written once to a shared folder and read from there; its size is known to the optimizer then. The shuffles behind it go."""
    return _stored(df, shared_folder(df.sparkSession))


@contextmanager
def kept_meanwhile(df: DataFrame) -> Iterator[DataFrame]:
    """kept(df), taken away at the end of the block."""
    path = shared_folder(df.sparkSession)
    try:
        yield _stored(df, path)
    finally:
        removed(df.sparkSession, path)


def removed(spark: SparkSession, path: str) -> None:
    """The folder is taken away, on whatever file system it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def settled(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of df, for small summaries that a report uses several times; Spark's cleaner removes it where it is told to."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_base(spark))
    return df.checkpoint(eager=True)
