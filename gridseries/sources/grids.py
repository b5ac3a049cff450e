"""Location grids as distributed ranges; no loop over cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.ordered import add_positions
from gridseries.schemas import CITY_FILE, LOCATION

# The built-in cities (name, latitude, longitude), ids by position.
CITIES = [
    ("New Delhi", 28.61, 77.23),
    ("Mumbai", 19.08, 72.88),
    ("Bangalore", 12.97, 77.59),
    ("Chennai", 13.08, 80.27),
    ("Kolkata", 22.57, 88.36),
    ("New York", 40.71, -74.01),
    ("Los Angeles", 34.05, -118.24),
    ("London", 51.51, -0.13),
    ("Tokyo", 35.68, 139.69),
    ("Sydney", -33.87, 151.21),
]

# Bounds of the India preset.
INDIA = {"lat_min": 8, "lat_max": 37, "lon_min": 68, "lon_max": 97}


class _Axis:
    """Half-open arithmetic sequence: ``start``, then multiples of the step as a double holds it."""

    def __init__(self, start, stop, step):
        if step <= 0:
            raise ValueError("the grid step must be positive")
        self.whole = all(float(v).is_integer() for v in (start, step))
        self.start = float(start)
        self.delta = (float(start) + float(step)) - float(start)
        self.size = max(0, math.ceil((stop - start) / step))

    def at(self, index: Column) -> Column:
        return F.lit(self.start) + index.cast("double") * F.lit(self.delta)

    def text(self, value: Column) -> Column:
        return value.cast("long").cast("string") if self.whole else value.cast("string")


def _grid(spark: SparkSession, lat: _Axis, lon: _Axis, grid_type: str, label: str) -> DataFrame:
    cells = spark.range(lat.size * lon.size)
    row, column = F.floor(F.col("id") / max(lon.size, 1)), F.col("id") % max(lon.size, 1)
    return cells.select(
        F.col("id").alias("location_id"),
        lat.at(row).alias("latitude"),
        lon.at(column).alias("longitude"),
        F.lit(grid_type).alias("grid_type"),
        F.concat_ws("_", F.lit(label), lat.text(lat.at(row)), lon.text(lon.at(column))).alias("description"),
    )


def global_grid(spark: SparkSession, lat_step=10, lon_step=10) -> DataFrame:
    """The whole globe, both poles and both sides of the 180 degree meridian included."""
    return _grid(spark, _Axis(-90, 91, lat_step), _Axis(-180, 181, lon_step), "global", "Global")


def regional_grid(spark: SparkSession, lat_min, lat_max, lon_min, lon_max, step=2) -> DataFrame:
    """A box; the last row and column pass the upper bound when the step does not divide the side."""
    return _grid(spark, _Axis(lat_min, lat_max + step, step), _Axis(lon_min, lon_max + step, step),
                 "regional", "Regional")


def india_grid(spark: SparkSession, step=2) -> DataFrame:
    return regional_grid(spark, **INDIA, step=step)


def city_locations(spark: SparkSession, csv_path: str | None = None, order_by: str | None = None) -> DataFrame:
    """The built-in cities, or a file of cities whose ids follow ``order_by`` (file order without one)."""
    if csv_path is None:
        rows = [(i, lat, lon, "city", name) for i, (name, lat, lon) in enumerate(CITIES)]
        return spark.createDataFrame(rows, LOCATION)
    cities = spark.read.schema(CITY_FILE).csv(csv_path, header=True)
    order = [order_by] if order_by else ["_place"]
    placed = add_positions(cities.withColumn("_place", F.monotonically_increasing_id()), "_row", [], order)
    return placed.select(
        (F.col("_row") - 1).alias("location_id"), "latitude", "longitude",
        F.lit("city").alias("grid_type"), F.col("city_name").alias("description"))


def first_locations(locations: DataFrame, count: int) -> DataFrame:
    return locations.orderBy("location_id").limit(count)
