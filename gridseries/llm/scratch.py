"""Hand-over tables in the folder that ``spark.checkpoint.dir`` names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gridseries import session


def folder(spark: SparkSession) -> str:
    """A fresh path in the shared folder; ``session.remove_scratch`` deletes it with all others of the application."""
    return session.scratch_path(spark, "llm")


def stored(df: DataFrame) -> DataFrame:
    """Write a frame and read it back: a short lineage that survives lost executors."""
    return session.materialize(df, "llm")
