"""Fitted parameters and the report of a cleaning run, stored as tables."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from gridseries.operators.scaling import Scaler
from gridseries.session import path_exists


@dataclass
class Fitted:
    """What a training run learned: a scaler and the categories of the encoded columns."""

    scaler: Scaler | None = None
    categories: DataFrame | None = None
    report: dict = field(default_factory=dict)


def save_artifacts(spark: SparkSession, fitted: Fitted, folder: str, prefix: str = "cleaning") -> None:
    """Scaler and categories only where fitted; the report always."""
    base = f"{folder.rstrip('/')}/{prefix}"
    if fitted.scaler is not None and fitted.scaler.centers:
        fitted.scaler.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{base}_scalers")
    if fitted.categories is not None:
        fitted.categories.write.mode("overwrite").parquet(f"{base}_encoders")
    text = json.dumps(fitted.report, default=str)
    spark.createDataFrame([(text,)], "report string").coalesce(1).write.mode("overwrite").text(f"{base}_report")


def load_artifacts(spark: SparkSession, folder: str, prefix: str = "cleaning") -> Fitted:
    """Parts that were never saved stay empty."""
    base = f"{folder.rstrip('/')}/{prefix}"
    fitted = Fitted()
    if path_exists(spark, f"{base}_scalers"):
        fitted.scaler = Scaler.from_frame(spark.read.parquet(f"{base}_scalers"))
    if path_exists(spark, f"{base}_encoders"):
        fitted.categories = spark.read.parquet(f"{base}_encoders")
    if path_exists(spark, f"{base}_report"):
        fitted.report = json.loads(spark.read.text(f"{base}_report").first()["value"])
    return fitted
