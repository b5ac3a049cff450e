"""Column expressions shared by the operators. Everything here stays inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.schemas import floating_columns

INFINITY = float("inf")

# Month to season (December to February is winter), calendar quarter to season.
SEASON_OF_MONTH = {
    12: "winter", 1: "winter", 2: "winter",
    3: "spring", 4: "spring", 5: "spring",
    6: "summer", 7: "summer", 8: "summer",
    9: "fall", 10: "fall", 11: "fall",
}
SEASON_OF_QUARTER = ["Winter", "Spring", "Summer", "Fall"]


def half_even(value: Column, places: int) -> Column:
    """Round to ``places`` with ties on the scaled binary value going to even; never gives -0.0."""
    scale = 10.0 ** places
    return F.rint(value * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def is_infinite(value: Column) -> Column:
    return F.abs(value) == F.lit(INFINITY)


def is_bad(value: Column) -> Column:
    return value.isNull() | F.isnan(value) | is_infinite(value)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL is the one missing marker: apply on read and after arithmetic that may give NaN."""
    chosen = floating_columns(df.schema) if columns is None else columns
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in chosen}) if chosen else df


def clip(value: Column, low, high) -> Column:
    """Clamp, with NULL kept as NULL (``least`` and ``greatest`` skip NULLs)."""
    low_value = low if isinstance(low, Column) else F.lit(low)
    high_value = high if isinstance(high, Column) else F.lit(high)
    return F.when(value.isNotNull(), F.least(F.greatest(value, low_value), high_value))


def trim_lower(value: Column) -> Column:
    """Strip every kind of white space at both ends and lower the case; NULL stays NULL."""
    return F.lower(F.regexp_replace(value, r"(?U)^\s+|\s+$", ""))


def parse_period(value: Column) -> Column:
    """``YYYYMM`` text to the first instant of the month; anything else gives NULL."""
    return F.try_to_timestamp(value, F.lit("yyyyMM"))


def is_annual(value: Column) -> Column:
    """The service adds a thirteenth period per year that holds the annual average."""
    return value.endswith("13")


def season_of(month: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in SEASON_OF_MONTH.items() for x in pair])
    return F.element_at(names, month.cast("int"))


def quarter_season_of(month: Column) -> Column:
    """Bins (0,3], (3,6], (6,9], (9,12], closed on the right."""
    names = F.array(*[F.lit(s) for s in SEASON_OF_QUARTER])
    return F.element_at(names, F.ceil(month / 3).cast("int"))


def season_flags(season: Column) -> dict[str, Column]:
    title = F.initcap(season)
    return {
        f"season_{name}": (title == F.lit(name)).cast("int")
        for name in ("Fall", "Spring", "Summer", "Winter")
    }


def month_angle(month: Column) -> Column:
    return F.lit(2 * math.pi) * month / F.lit(12)


def heat_index(temperature: Column, humidity: Column, variant: str = "master") -> Column:
    if variant == "master":
        return temperature + F.lit(0.1) * humidity
    if variant == "scoring":
        return temperature + F.lit(0.5) * humidity / F.lit(100)
    raise ValueError(f"unknown heat index variant: {variant}")


def year_norm(year: Column, first: int = 2010, last: int = 2024) -> Column:
    return (year - F.lit(first)) / F.lit(float(last - first))
