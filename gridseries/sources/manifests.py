"""Request manifests: one row with one URL per location, for a downloader outside Spark."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.schemas import PARAMETERS, WINDOW_PARAMETERS

# The public data service and its end points.
BASE_URL = "https://power.larc.nasa.gov"
MONTHLY = "/api/temporal/monthly/point"
CLIMATOLOGY = "/api/temporal/monthly/climatology/point"
INDICATORS = "/api/application/indicators/point"


def _degrees(column: str, whole_degrees: bool) -> Column:
    text = F.col(column).cast("string")
    return F.regexp_replace(text, r"\.0$", "") if whole_degrees else text


def _url(endpoint: str, query: list[tuple[str, Column | str]]) -> Column:
    parts = [F.lit(BASE_URL + endpoint)]
    for place, (name, value) in enumerate(query):
        parts.append(F.lit(f"{'&' if place else '?'}{name}="))
        parts.append(value if isinstance(value, Column) else F.lit(str(value)))
    return F.concat(*parts)


def _point_manifest(locations, endpoint, start_year, end_year, parameters, whole_degrees) -> DataFrame:
    return locations.withColumn("url", _url(endpoint, [
        ("parameters", ",".join(parameters)),
        ("community", "SB"),
        ("longitude", _degrees("longitude", whole_degrees)),
        ("latitude", _degrees("latitude", whole_degrees)),
        ("format", "JSON"),
        ("start", start_year),
        ("end", end_year),
    ]))


def monthly_manifest(locations: DataFrame, start_year: int, end_year: int,
                     parameters: list[str] | None = None, whole_degrees: bool = False) -> DataFrame:
    """``whole_degrees`` writes 30 instead of 30.0, for grids with a whole step."""
    return _point_manifest(locations, MONTHLY, start_year, end_year, parameters or PARAMETERS, whole_degrees)


def climatology_manifest(locations: DataFrame, start_year: int, end_year: int,
                         parameters: list[str] | None = None, whole_degrees: bool = False) -> DataFrame:
    return _point_manifest(locations, CLIMATOLOGY, start_year, end_year, parameters or PARAMETERS, whole_degrees)


def indicators_manifest(locations: DataFrame, start_year: int, end_year: int,
                        format_type: str = "JSON", whole_degrees: bool = False) -> DataFrame:
    return locations.withColumn("url", _url(INDICATORS, [
        ("longitude", _degrees("longitude", whole_degrees)),
        ("latitude", _degrees("latitude", whole_degrees)),
        ("start", start_year),
        ("end", end_year),
        ("format", format_type),
    ]))


def window_manifest(requests: DataFrame, as_of: dt.date) -> DataFrame:
    """Requests (latitude, longitude, months_back) for the trailing ``30 * months_back`` days."""
    start = F.date_sub(F.lit(as_of), (F.col("months_back") * 30).cast("int"))
    return requests.withColumn("url", _url(MONTHLY, [
        ("parameters", ",".join(WINDOW_PARAMETERS)),
        ("community", "RE"),
        ("longitude", _degrees("longitude", False)),
        ("latitude", _degrees("latitude", False)),
        ("start", F.date_format(start, "yyyyMM")),
        ("end", f"{as_of:%Y%m}"),
        ("format", "JSON"),
    ]))


def with_landing_name(manifest: DataFrame, start_year: int, end_year: int,
                      kind: str = "temporal_monthly") -> DataFrame:
    """The file name under which the downloader stores each response."""
    return manifest.withColumn("file_name", F.concat(
        F.lit(f"{kind}_"), F.col("location_id").cast("string"), F.lit(f"_{start_year}_{end_year}.json")))
