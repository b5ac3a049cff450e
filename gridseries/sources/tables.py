"""Reading and writing the tables of a run: CSV at the edges, parquet in between."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.functions.columns import nan_to_null
from gridseries.schemas import BASELINE, require_columns
from gridseries.session import path_exists


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Declared types, infinities as values, NaN as NULL."""
    frame = (
        spark.read.schema(schema)
        .options(header=True, positiveInf="inf", negativeInf="-inf", nanValue="nan")
        .csv(path)
    )
    return nan_to_null(frame)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV by its ending, else parquet."""
    if path.endswith(".csv"):
        if schema is None:
            raise ValueError(f"a schema is needed to read {path}")
        return read_csv(spark, path, schema)
    return nan_to_null(spark.read.parquet(path))


def first_available(spark: SparkSession, paths: list[str]) -> str:
    for path in paths:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exist: {paths}")


def read_baseline_input(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    """The first table that holds real values; cleaned tables hold scaled ones and are refused."""
    usable = [p for p in paths if "cleaned" not in os.path.basename(p.rstrip("/"))]
    frame = read_table(spark, first_available(spark, usable), schema)
    if "month" not in frame.columns and "time" in frame.columns:
        frame = frame.withColumn("month", F.month("time"))
    require_columns(frame.columns, ["latitude", "longitude", "month", "T2M", "PRECTOTCORR"])
    return frame


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        timestampFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS]").csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Parquet, or CSV by the ending of the path."""
    if path.endswith(".csv"):
        write_csv(df, path)
        return
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_unless_empty(df: DataFrame | None, path: str) -> bool:
    if df is None or df.isEmpty():
        return False
    write_table(df, path)
    return True


def write_master(df: DataFrame, path: str) -> None:
    """By year, so that period filters prune; each year's rows meet in few files."""
    if path.endswith(".csv"):
        write_csv(df, path)
        return
    spread = df.repartition(F.col("year"), F.pmod(F.xxhash64("location_id", "time"), F.lit(64)))
    write_table(spread.sortWithinPartitions("year", "location_id", "time"), path, ["year"])


def cleaned_path(path: str) -> str:
    """``master`` in the name becomes ``cleaned``; other names get the suffix ``_cleaned``."""
    folder, name = os.path.split(path.rstrip("/"))
    stem, ending = os.path.splitext(name)
    stem = stem.replace("master", "cleaned") if "master" in stem else f"{stem}_cleaned"
    return os.path.join(folder, stem + ending)


def baseline_key(lat: str = "lat_rounded", lon: str = "lon_rounded", month: str = "month"):
    return F.format_string("%.2f,%.2f,%d", F.col(lat), F.col(lon), F.col(month))


def keyed_baselines(baselines: DataFrame) -> DataFrame:
    """One keyed record per (place, month), as the JSON export holds it."""
    return baselines.select(
        baseline_key().alias("key"),
        F.col("baseline_temp").alias("temperature"),
        F.col("baseline_precip").alias("precipitation"),
        "latitude", "longitude")


def write_baselines(baselines: DataFrame, table_path: str, json_path: str | None = None) -> None:
    write_table(baselines, table_path)
    if json_path:
        keyed_baselines(baselines).write.mode("overwrite").json(json_path)


def read_baselines(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, BASELINE)
