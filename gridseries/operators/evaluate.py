"""Regression metrics, multi-target loss and error histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.schemas import TARGETS


def regression_metrics(df: DataFrame, targets: list[str] = TARGETS) -> DataFrame:
    """``target, mae, rmse, r2`` per target, one aggregate for all; R² of a constant target is 1 or 0."""
    errors = {t: F.col(t) - F.col(f"{t}_predicted") for t in targets}
    totals = df.agg(*[
        aggregate.alias(f"{name}{i}")
        for i, t in enumerate(targets)
        for name, aggregate in (
            ("mae", F.avg(F.abs(errors[t]))),
            ("mse", F.avg(errors[t] * errors[t])),
            ("var", F.var_pop(F.when(errors[t].isNotNull(), F.col(t)))))
    ])
    entries = []
    for i, t in enumerate(targets):
        mse, variance = F.col(f"mse{i}"), F.col(f"var{i}")
        constant = F.when(mse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
        r2 = F.when(variance == 0, constant).otherwise(F.lit(1.0) - F.try_divide(mse, variance))
        entries.append(F.struct(
            F.lit(t).alias("target"), F.col(f"mae{i}").alias("mae"), F.sqrt(mse).alias("rmse"), r2.alias("r2")))
    return totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def overall_loss(df: DataFrame, targets: list[str] = TARGETS) -> DataFrame:
    """Mean squared and mean absolute error averaged over all targets, and the root of the first."""
    errors = {t: F.col(t) - F.col(f"{t}_predicted") for t in targets}
    mse = sum((F.avg(e * e) for e in errors.values()), F.lit(0.0)) / len(targets)
    mae = sum((F.avg(F.abs(e)) for e in errors.values()), F.lit(0.0)) / len(targets)
    return df.agg(mse.alias("loss"), mae.alias("mae")).withColumn("rmse", F.sqrt("loss"))


def error_metrics(columns: list[str]) -> list[Column]:
    """Range and mean of error columns, to be observed while predictions are saved or taken in one aggregate."""
    return [f(_number(c)).alias(f"{name} of {c}") for c in columns
            for name, f in (("low", F.min), ("high", F.max), ("mean", F.avg))]


def _number(column: str) -> Column:
    return F.when(~F.isnan(column), F.col(column))


def error_histogram(df: DataFrame, column: str, bins: int = 50, seen=None) -> DataFrame:
    """``bin, low, high, count`` for equal bins from minimum to maximum, the last one closed, empty ones kept.

    ``seen`` holds the ``error_metrics`` of the rows where a pass has taken them; the histogram is then one scan.
    """
    value = _number(column)
    row = seen or df.agg(*error_metrics([column])).first()
    low, high = row[f"low of {column}"], row[f"high of {column}"]
    if low is None:
        low, high = 0.0, 1.0
    elif low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins

    def edge(index: Column) -> Column:
        return F.when(index == bins, F.lit(high)).otherwise(index * F.lit(step) + F.lit(low))

    guess = F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * bins), F.lit(bins - 1))
    # The division may land one bin off; the edges decide.
    index = (
        F.when(value < edge(guess), guess - 1)
        .when((value >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counts = (
        df.where(value.isNotNull()).select(index.cast("int").alias("_bin"))
        .groupBy("_bin").agg(F.count(F.lit(1)).alias("_count"))
    )
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(F.broadcast(counts), every["bin"] == counts["_bin"], "left")
        .select("bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"),
                F.coalesce("_count", F.lit(0)).alias("count"))
    )
