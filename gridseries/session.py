"""Session defaults and the shared folder for checkpoints and hand-over tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_scratch: dict[str, list[str]] = {}


def build_session(app_name: str = "gridseries", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a session that names none uses its warehouse, which is shared too.

    It is set on the context as checkpoint folder where the context has none.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or context.getConf().get(CHECKPOINT_SETTING)
    folder = folder or context.getCheckpointDir() or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_handover"
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, remembered until ``remove_scratch``."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a short lineage that survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_observed(df: DataFrame, name: str, metrics: list[Column]) -> tuple[DataFrame, dict]:
    """``materialize`` that also gives named aggregates of the rows, taken while they are written: no scan of their own.

    Spark adds the values of a writing task once, however often the task is repeated.
    """
    if not metrics:
        return materialize(df, name), {}
    seen = Observation()
    return materialize(df.observe(seen, *metrics), name), seen.get


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has handed over between its steps; frames that read it can't be used any more."""
    for path in _scratch.pop(spark.sparkContext.applicationId, []):
        remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder or file, if it is there, on whatever file system its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Around a whole job: its hand-over tables go at the end, also when it fails."""
    try:
        yield
    finally:
        remove_scratch(spark)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    file_system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return file_system.exists(hadoop_path)
