"""Climatology of a base period and deviations from it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.schemas import TEMPERATURES

PERIOD = (1981, 2010)


def in_period(df: DataFrame, period: tuple[int, int] = PERIOD, time: str = "time") -> DataFrame:
    """Years of the period, both ends included, as a plain range on the time column.

    A range of instants is pushed to the scan; ``year(time)`` would not be.
    """
    first, last = period
    return df.where(
        (F.col(time) >= F.lit(f"{first:04d}-01-01").cast("timestamp"))
        & (F.col(time) < F.lit(f"{last + 1:04d}-01-01").cast("timestamp")))


def climatology(df: DataFrame, period: tuple[int, int] = PERIOD,
                parameters: list[str] = TEMPERATURES) -> DataFrame:
    """Mean by (location, month) over the period, as ``<parameter>_baseline``."""
    present = [p for p in parameters if p in df.columns]
    return (
        in_period(df, period).where(F.col("location_id").isNotNull())
        .groupBy("location_id", F.month("time").alias("month"))
        .agg(*[F.avg(p).alias(f"{p}_baseline") for p in present])
    )


def anomalies(df: DataFrame, period: tuple[int, int] = PERIOD,
              parameters: list[str] = TEMPERATURES) -> DataFrame:
    """Add ``<parameter>_anom``; NULL where the period has no value. ``year`` and ``month`` go."""
    present = [p for p in parameters if p in df.columns]
    normals = climatology(df, period, present)
    facts = df.drop("year", "month", *[c for c in df.columns if c.endswith("_baseline")])
    joined = facts.withColumn("month", F.month("time")).join(normals, ["location_id", "month"], "left")
    return (
        joined.withColumns({f"{p}_anom": F.col(p) - F.col(f"{p}_baseline") for p in present})
        .drop("month", *[f"{p}_baseline" for p in present])
    )
