"""Climate-shaped views over the given tables, for the registered queries and the bench."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.schemas import PARAMETERS


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def series(spark: SparkSession, folder: str) -> DataFrame:
    """One row per (location, month): order lines by supplier and shipping month."""
    lines = table(spark, folder, "lineitem")
    return lines.groupBy(
        F.col("l_suppkey").alias("location_id"),
        F.date_trunc("month", "l_shipdate").cast("timestamp").alias("time"),
    ).agg(
        F.avg(F.col("l_partkey") % 300).alias("ALLSKY_SFC_SW_DWN"),
        F.avg(F.rint(F.col("l_discount") * 100)).alias("PRECTOTCORR"),
        F.avg("l_linenumber").alias("QV2M"),
        (F.avg(F.rint(F.col("l_tax") * 100)) * 10).alias("RH2M"),
        F.avg("l_quantity").alias("T2M"),
        F.max("l_quantity").alias("T2M_MAX"),
        F.min("l_quantity").alias("T2M_MIN"),
    )


def latitude_of(key: Column) -> Column:
    return ((key * 37) % 181 - 90) * F.lit(0.99) + F.lit(0.004)


def longitude_of(key: Column) -> Column:
    return ((key * 73) % 361 - 180) * F.lit(0.99)


def locations(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as places."""
    key = F.col("s_suppkey")
    return table(spark, folder, "supplier").select(
        key.alias("location_id"), latitude_of(key).alias("latitude"), longitude_of(key).alias("longitude"),
        F.lit("global").alias("grid_type"), F.col("s_name").alias("description"))


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as scenario requests; the first ones share their place with a supplier."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("request_id"), latitude_of(key).alias("latitude"), longitude_of(key).alias("longitude"),
        (2025 + key % 5).cast("int").alias("year"), (key % 12 + 1).cast("int").alias("month"),
        (1 + key % 3).cast("int").alias("months"))


def unique_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Events with gaps, infinities and untidy text, placed by the event number."""
    number, value = F.col("event_id"), F.col("value")
    infinity = F.lit(float("inf"))
    return table(spark, folder, "events").select(
        number, F.col("user_id").alias("location_id"), F.col("ts").cast("timestamp").alias("time"),
        F.when(number % 7 == 0, F.lit(None)).when(number % 101 == 0, infinity)
        .when(number % 103 == 0, -infinity).otherwise(value).alias("T2M"),
        F.when(~(number % 11).isin(0, 1), value * 2).alias("RH2M"),
        value.alias("PRECTOTCORR"),
        F.when(number % 13 != 0, F.concat(F.lit(" "), F.upper("event_type"), F.lit(" "))).alias("season"))


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    """The same with every fiftieth row repeated."""
    once = unique_dirty(spark, folder)
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return once.withColumn("_copy", F.explode(copies)).drop("_copy")


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """The series as response text, one per (location, year), with the annual average as month 13."""
    period = F.date_format("time", "yyyyMM")
    yearly = series(spark, folder).groupBy("location_id", F.year("time").alias("year")).agg(*[
        F.map_concat(
            F.map_from_entries(F.collect_list(F.struct(period, F.col(p)))),
            F.create_map(F.concat(F.min(F.date_format("time", "yyyy")), F.lit("13")), F.avg(p)),
        ).alias(p) for p in PARAMETERS
    ])
    nested = F.create_map(*[x for p in PARAMETERS for x in (F.lit(p), F.col(p))])
    text = F.to_json(F.struct(F.struct(nested.alias("parameter")).alias("properties")))
    return yearly.select("location_id", F.col("year").cast("string").alias("request"), text.alias("response"))


def series_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The series with gaps by calendar month."""
    month = F.month("time")
    return series(spark, folder).select(
        "location_id", "time",
        F.when(month % 5 != 0, F.col("T2M")).alias("T2M"), F.when(month % 3 != 0, F.col("RH2M")).alias("RH2M"))


def derived_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Dirty rows with values of many decimals."""
    return unique_dirty(spark, folder).withColumns({"T2M": F.col("T2M") / 7, "RH2M": F.col("RH2M") / 3})
