"""Equi joins of a large fact with a lookup table: a broadcast of measured size, else a shuffle.

A shuffled join leaves hot keys to adaptive execution (``spark.sql.adaptive.skewJoin``, on in ``build_session``), which
splits the fact's rows of a key by their measured size and copies only that key's lookup rows. Lookup tables that are
computed from the fact are joined plainly: measuring them first would compute them twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.functions.columns import half_even

BROADCAST_BYTES = 64 * 1024 * 1024


def fits_broadcast(dim: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Measure the lookup table: rows times fixed widths plus the bytes of its text and nested values."""
    sized = {f.name: F.col(f.name) for f in dim.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))}
    sized |= {f.name: F.to_json(F.struct(f.name)) for f in dim.schema
              if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))}
    fixed = 16 + 16 * len(dim.columns)
    measured = dim.agg(
        F.count(F.lit(1)).alias("rows"),
        sum((F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in sized.values()), F.lit(0)).alias("text"),
    ).first()
    return measured["rows"] * fixed + measured["text"] <= limit


def lookup_join(fact: DataFrame, dim: DataFrame, on: list[str], how: str = "left",
                limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join a stored lookup table: broadcast when its measured size allows, else shuffled."""
    return fact.join(F.broadcast(dim) if fits_broadcast(dim, limit) else dim, on, how)


def join_location_metadata(climate: DataFrame, locations: DataFrame) -> DataFrame:
    """Add ``grid_type`` and ``description``; rows of unknown locations stay, with NULLs."""
    chosen = locations.select("location_id", "grid_type", "description")
    return lookup_join(climate, chosen, ["location_id"])


def missing_locations(requested: DataFrame, landed: DataFrame) -> DataFrame:
    """Requested locations without any landed row."""
    return requested.join(landed.select("location_id").distinct(), "location_id", "left_anti")


def coordinate_keys(latitude: Column, longitude: Column) -> dict[str, Column]:
    """Coordinates to two decimals; -0.0 becomes 0.0, so both sides of the equator meet."""
    return {"lat_rounded": half_even(latitude, 2), "lon_rounded": half_even(longitude, 2)}
