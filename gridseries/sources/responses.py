"""Nested responses to one row per (location, month), without a shuffle.

A response holds parameter -> period -> value. Its periods are exploded once and every parameter is
looked up per period, so the transposition stays inside the row and needs no pivot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions.columns import is_annual, parse_period
from gridseries.operators.joins import lookup_join
from gridseries.schemas import PACKED_RESPONSE, PARAMETERS, RESPONSE, WINDOW_PARAMETERS

FILE_NAME = r"{kind}_(\d+)_\d+_\d+\.json$"


def read_landing(spark: SparkSession, path: str, kind: str = "temporal_monthly") -> DataFrame:
    """Landed files as rows of ``location_id, request, properties``; the id comes from the file name."""
    files = spark.read.schema(RESPONSE).option("multiLine", True).json(path)
    return identify(files, kind)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    """Responses that the downloader packed as JSON lines, each with its ``location_id`` and ``request``.

    The form to prefer for many locations: lines split and pack into full tasks, single files do not.
    """
    return spark.read.schema(PACKED_RESPONSE).json(path)


def identify(files: DataFrame, kind: str = "temporal_monthly") -> DataFrame:
    name = F.col("_metadata.file_name")
    number = F.regexp_extract(name, FILE_NAME.format(kind=kind), 1)
    return files.select(
        F.nullif(number, F.lit("")).cast("long").alias("location_id"),
        name.alias("request"), "properties")


def parse_text(responses: DataFrame, column: str) -> DataFrame:
    """The same for response text held in a column."""
    parsed = F.from_json(column, RESPONSE)
    return responses.withColumn("properties", parsed["properties"]).drop(column)


def periods_of(by_parameter: Column) -> Column:
    """All periods that any parameter has, once each."""
    return F.array_distinct(F.flatten(F.map_values(F.transform_values(by_parameter, lambda _, months: F.map_keys(months)))))


def value_at(by_parameter: Column, parameter: str, period: Column, sentinel: float | None = None) -> Column:
    found = F.try_element_at(F.try_element_at(by_parameter, F.lit(parameter)), period)
    if sentinel is not None:
        found = F.nullif(found, F.lit(float(sentinel)))
    return F.when(~F.isnan(found), found)


def unpivot(responses: DataFrame, parameters: list[str] = PARAMETERS,
            sentinel: float | None = None) -> DataFrame:
    """One row per period of each response; a response without parameters gives none.

    ``sentinel`` turns the service's fill value into NULL; off by default.
    """
    by_parameter = F.col("properties.parameter")
    kept = [c for c in responses.columns if c != "properties"]

    def value(parameter: str) -> Column:
        return value_at(by_parameter, parameter, F.col("period"), sentinel).alias(parameter)

    return (
        responses.select(*kept, "properties", F.explode(periods_of(by_parameter)).alias("period"))
        .select(*kept, "period", *[value(p) for p in parameters])
    )


def monthly_rows(responses: DataFrame, parameters: list[str] = PARAMETERS,
                 sentinel: float | None = None) -> DataFrame:
    """Monthly facts with ``time``; the annual averages of period 13 are dropped."""
    rows = unpivot(responses, sorted(parameters), sentinel).where(~is_annual(F.col("period")))
    return rows.withColumn("time", parse_period(F.col("period"))).drop("period")


def climatology_rows(responses: DataFrame, parameters: list[str] = PARAMETERS) -> DataFrame:
    """Climatology keeps its period label as text and every period."""
    return unpivot(responses, sorted(parameters))


def window_rows(responses: DataFrame, parameters: list[str] = WINDOW_PARAMETERS) -> DataFrame:
    """Rows for scoring: ``date, year, month`` and the six parameters of a trailing window."""
    rows = unpivot(responses, parameters).where(~is_annual(F.col("period")))
    return (
        rows.withColumn("date", parse_period(F.col("period"))).drop("period")
        .withColumns({"year": F.year("date"), "month": F.month("date")})
    )


def with_coordinates(rows: DataFrame, locations: DataFrame) -> DataFrame:
    """Responses do not carry the requested point; it comes from the location table."""
    return lookup_join(rows, locations.select("location_id", "latitude", "longitude"), ["location_id"])


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column that one frame lacks is NULL there."""
    if not frames:
        raise ValueError("nothing to union")
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined
