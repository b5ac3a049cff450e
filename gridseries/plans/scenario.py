"""Future scenarios: one row per (place, month), estimated climate, features, predicted values."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.functions import columns as C
from gridseries.operators.baselines import exact_baseline
from gridseries.operators.features import cyclical_month, fixed_year_norm, measured_features, season_dummies, transformed_features
from gridseries.schemas import FEATURES

# Upper ends of the latitude zones with mean temperature and seasonal range, then the last zone.
TEMPERATURE_ZONES = [(23.5, 27.0, 3.0), (35.0, 22.0, 10.0), (50.0, 15.0, 15.0), (60.0, 8.0, 20.0)]
POLAR = (-5.0, 25.0)
# Upper ends of the rain zones with their base amounts, then the last zone.
RAIN_ZONES = [(10.0, 200.0), (30.0, 100.0), (50.0, 60.0)]
POLAR_RAIN = 40.0

# Accepted ranges of a request.
RANGES = {"latitude": (-90, 90), "longitude": (-180, 180), "month": (1, 12), "months_back": (12, 60)}


def check_ranges(requests: DataFrame) -> DataFrame:
    """Add ``valid`` and ``reason`` (the first column out of range or missing)."""
    reason = F.coalesce(*[
        F.when(F.col(c).isNull() | ~F.col(c).between(low, high), F.lit(f"{c} must be between {low} and {high}"))
        for c, (low, high) in RANGES.items() if c in requests.columns
    ])
    return requests.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())


def split_valid(requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid requests, and the others with their reason."""
    checked = check_ranges(requests)
    return checked.where("valid").drop("valid", "reason"), checked.where("not valid").drop("valid")


def assert_ranges(requests: DataFrame) -> DataFrame:
    """Strict form: the job fails with the reason of the first bad request it meets.

    The check sits in the value of ``latitude`` so that column pruning cannot remove it.
    """
    checked = check_ranges(requests)
    guarded = F.when(F.col("valid"), F.col("latitude")).otherwise(F.raise_error(F.col("reason")).cast("double"))
    return checked.withColumn("latitude", guarded).drop("valid", "reason")


def expand_months(requests: DataFrame, months: str = "months") -> DataFrame:
    """Requests (year, month, months) to one row per consecutive month."""
    start = F.make_date("year", "month", F.lit(1))
    steps = F.explode(F.sequence(F.lit(0), F.col(months) - 1))
    return (
        requests.where(F.col(months) >= 1).withColumn("_first", start).withColumn("_step", steps)
        .withColumn("_date", F.add_months("_first", F.col("_step")))
        .withColumns({"year": F.year("_date"), "month": F.month("_date")})
        .drop("_first", "_step", "_date", months)
    )


def _by_zone(size: Column, zones: list[tuple], last: float, part: int) -> Column:
    chain = F.when(size < zones[0][0], F.lit(zones[0][part]))
    for zone in zones[1:]:
        chain = chain.when(size < zone[0], F.lit(zone[part]))
    return chain.otherwise(F.lit(last))


def season_wave(month: Column) -> Column:
    """-1 in January, 1 in July."""
    return F.sin(F.lit(2 * math.pi) * (month - 1) / 12 - F.lit(math.pi / 2))


def effective_month(latitude: Column, month: Column) -> Column:
    """South of the equator the seasons are half a year apart."""
    return F.when(latitude >= 0, month).otherwise((month + 5) % 12 + 1)


def zone_temperature(latitude: Column, month: Column) -> Column:
    size = F.abs(latitude)
    mean = _by_zone(size, TEMPERATURE_ZONES, POLAR[0], 1)
    span = _by_zone(size, TEMPERATURE_ZONES, POLAR[1], 2)
    return mean + season_wave(month) * span


def zone_rain(latitude: Column, month: Column) -> Column:
    size = F.abs(latitude)
    peak = F.sin(F.lit(2 * math.pi) * (month - 6) / 12)
    factor = (
        F.when(size < 10, F.lit(1.0))
        .when(size < 30, F.lit(0.5) + F.lit(1.5) * F.greatest(F.lit(0.0), peak))
        .when(size < 50, F.lit(0.8) + F.lit(0.4) * peak)
        .otherwise(F.lit(1.0))
    )
    return _by_zone(size, RAIN_ZONES, POLAR_RAIN, 1) * factor


def estimate_climate(requests: DataFrame, baselines: DataFrame | None = None, stored: bool = False,
                     hemisphere_fix: bool = False) -> DataFrame:
    """Seven parameters per (latitude, longitude, month), from the exact normal or by latitude zone.

    Also ``baseline_temp``, ``baseline_precip`` and ``estimated_from``. With a normal the sun follows the
    plain month even in the south; ``hemisphere_fix`` shifts it there as well.
    """
    if baselines is None:
        frame = requests.withColumns({
            "baseline_temp": F.lit(None).cast("double"), "baseline_precip": F.lit(None).cast("double")})
    else:
        frame = exact_baseline(requests, baselines, stored)
    latitude, month = F.col("latitude"), F.col("month")
    shifted = effective_month(latitude, month)
    known = F.col("baseline_temp").isNotNull() & F.col("baseline_precip").isNotNull()
    frame = frame.withColumns({
        "estimated_from": F.when(known, "baseline").otherwise("zone"),
        "_sun_month": shifted if hemisphere_fix else F.when(known, month).otherwise(shifted),
        "T2M": F.when(known, F.col("baseline_temp")).otherwise(zone_temperature(latitude, shifted)),
        "PRECTOTCORR": F.when(known, F.col("baseline_precip")).otherwise(zone_rain(latitude, shifted)),
    })
    temperature, rain = F.col("T2M"), F.col("PRECTOTCORR")
    frame = frame.withColumns({
        "T2M_MAX": temperature + 7,
        "T2M_MIN": temperature - 7,
        "RH2M": C.clip(F.lit(70) - temperature * 0.8 + rain / 100 * 10, 20.0, 95.0),
        "ALLSKY_SFC_SW_DWN": (F.lit(220) * (F.lit(1) - F.abs(latitude) / 90 * 0.3)
                              * (F.lit(0.7) + F.lit(0.3) * season_wave(F.col("_sun_month")))),
        "baseline_temp": temperature,
        "baseline_precip": rain,
    })
    vapour = F.exp(F.lit(17.27) * F.col("T2M") / (F.col("T2M") + 237.3))
    humidity = F.lit(0.622) * 0.01 * F.col("RH2M") * vapour / 1013.25 * 15
    return frame.withColumn("QV2M", humidity).drop("_sun_month")


def scenario_features(requests: DataFrame, baselines: DataFrame | None = None, scaler=None,
                      stored: bool = False, hemisphere_fix: bool = False) -> DataFrame:
    """Requests (latitude, longitude, year, month) with the 18 model features and the baselines."""
    frame = estimate_climate(requests, baselines, stored, hemisphere_fix)
    frame = season_dummies(fixed_year_norm(cyclical_month(measured_features(frame, "scoring"))))
    return transformed_features(frame, scaler)


def feature_matrix(frame: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return frame.select(*[k for k in keys or [] if k not in FEATURES], *FEATURES)


def predicted_values(df: DataFrame, temperature: str = "T2M_anom_predicted",
                     precipitation: str = "PRECTOTCORR_anom_predicted") -> DataFrame:
    """Baseline plus anomaly; precipitation never below zero."""
    rain = F.col("baseline_precip") + F.col(precipitation)
    return df.withColumns({
        "predicted_temp": F.col("baseline_temp") + F.col(temperature),
        "predicted_precip": F.when(rain.isNotNull(), F.greatest(F.lit(0.0), rain)),
    })


def two_way_labels(df: DataFrame, temperature: str, precipitation: str) -> DataFrame:
    return df.withColumns({
        "temperature_label": F.when(F.col(temperature) > 0, "warmer than average").otherwise("cooler than average"),
        "precipitation_label": F.when(F.col(precipitation) > 0, "wetter than average").otherwise("drier than average"),
    })


def three_way_labels(df: DataFrame, temperature: str, precipitation: str, tolerance: float = 0.1) -> DataFrame:
    def status(column: str, above: str, below: str) -> Column:
        value = F.col(column)
        return F.when(F.abs(value) < tolerance, "Normal").when(value > 0, above).otherwise(below)

    return df.withColumns({
        "temperature_status": status(temperature, "Warmer than average", "Cooler than average"),
        "precipitation_status": status(
            precipitation, "More precipitation than average", "Less precipitation than average"),
    })


def prediction_records(df: DataFrame, temperature: str = "T2M_anom_predicted",
                       precipitation: str = "PRECTOTCORR_anom_predicted") -> DataFrame:
    """The nested record of each prediction."""
    labelled = two_way_labels(df, temperature, precipitation)
    month_name = F.date_format(F.make_date("year", "month", F.lit(1)), "MMM")
    return labelled.select(
        F.struct("latitude", "longitude").alias("location"),
        F.struct("year", "month", month_name.alias("month_name")).alias("date"),
        F.struct(F.col("baseline_temp").alias("temperature"),
                 F.col("baseline_precip").alias("precipitation")).alias("baseline"),
        F.struct(F.col(temperature).alias("temperature"),
                 F.col(precipitation).alias("precipitation")).alias("anomalies"),
        F.struct(F.col("predicted_temp").alias("temperature"),
                 F.col("predicted_precip").alias("precipitation")).alias("predictions"),
        F.struct(F.col("temperature_label").alias("temperature"),
                 F.col("precipitation_label").alias("precipitation")).alias("interpretation"),
    )
