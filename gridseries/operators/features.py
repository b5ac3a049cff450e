"""Derived features, lags and deviations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.functions import columns as C
from gridseries.operators.ordered import BLOCK_ROWS, lag_columns
from gridseries.schemas import CONTINUOUS, LAG_MONTHS, LAGGED, TARGETS


def derived_features(df: DataFrame, heat_variant: str = "master") -> DataFrame:
    """Temperature range, heat index and log precipitation where the inputs exist; month, season, year."""
    return calendar_features(measured_features(df, heat_variant))


def measured_features(df: DataFrame, heat_variant: str = "master") -> DataFrame:
    present = set(df.columns)
    added = {}
    if {"T2M_MAX", "T2M_MIN"} <= present:
        added["T2M_range"] = F.col("T2M_MAX") - F.col("T2M_MIN")
    if {"T2M", "RH2M"} <= present:
        added["heat_index"] = C.heat_index(F.col("T2M"), F.col("RH2M"), heat_variant)
    if "PRECTOTCORR" in present:
        added["precip_log"] = F.log1p("PRECTOTCORR")
    return df.withColumns(added) if added else df


def calendar_features(df: DataFrame, time: str = "time") -> DataFrame:
    month = F.month(time)
    return df.withColumns({"month": month, "season": C.season_of(month), "year": F.year(time)})


def cyclical_month(df: DataFrame, month: str = "month") -> DataFrame:
    angle = C.month_angle(F.col(month))
    return df.withColumns({"month_sin": F.sin(angle), "month_cos": F.cos(angle)})


def fixed_year_norm(df: DataFrame, year: str = "year", first: int = 2010, last: int = 2024) -> DataFrame:
    """Position of the year in a fixed range; beyond the range it passes 0 and 1."""
    return df.withColumn("year_norm", C.year_norm(F.col(year), first, last))


def season_dummies(df: DataFrame, variant: str = "meteorological", month: str = "month") -> DataFrame:
    """Four 0/1 columns; ``quarter`` takes January to March as winter."""
    if variant == "meteorological":
        season = C.season_of(F.col(month))
    elif variant == "quarter":
        season = C.quarter_season_of(F.col(month))
    else:
        raise ValueError(f"unknown season variant: {variant}")
    return df.withColumns(C.season_flags(season))


def transformed_features(df: DataFrame, scaler=None, features: list[str] = CONTINUOUS) -> DataFrame:
    """``<feature>_transformed``: scaled where the scaler knows the feature, else the value itself."""
    expressions = scaler.expressions() if scaler is not None else {}
    return df.withColumns({
        f"{c}_transformed": expressions.get(c, F.col(c)) for c in features if c in df.columns
    })


def lag_features(df: DataFrame, lag_months: list[int] = LAG_MONTHS, columns: list[str] = LAGGED,
                 group_by: str = "location_id", order_by: list[str] | None = None,
                 block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """``<column>_lag<n>``: the value n rows earlier at the same location."""
    lags = {f"{c}_lag{n}": (c, n) for c in columns if c in df.columns for n in lag_months}
    return lag_columns(df, lags, [group_by], order_by or ["time"], block_rows)


def complete_rows(df: DataFrame) -> DataFrame:
    """Rows without NULL or NaN in any column."""
    return C.nan_to_null(df).dropna("any")


def deviation_from_mean(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """``<column>_anom``: the value minus the mean of its request.

    A partial aggregate and a join instead of a window, so that one large request can be split.
    """
    chosen = columns or [t.removesuffix("_anom") for t in TARGETS]
    means = df.groupBy(*keys).agg(*[F.avg(c).alias(f"_mean_{c}") for c in chosen])
    joined = df.join(means, keys, "left")
    return (
        joined.withColumns({f"{c}_anom": F.col(c) - F.col(f"_mean_{c}") for c in chosen})
        .drop(*[f"_mean_{c}" for c in chosen])
    )


def relative_year_norm(df: DataFrame, keys: list[str], year: str = "year") -> DataFrame:
    """Min-max position of the year inside its request."""
    ends = df.groupBy(*keys).agg(F.min(year).alias("_first"), F.max(year).alias("_last"))
    span = F.col("_last") - F.col("_first") + F.lit(1e-8)
    return (
        df.join(ends, keys, "left")
        .withColumn("year_norm", (F.col(year) - F.col("_first")) / span)
        .drop("_first", "_last")
    )
