"""Uniform formats: times, text, decimals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.functions.columns import half_even, trim_lower
from gridseries.schemas import NOT_SCALED, floating_columns, text_columns

PLACES = 4


def standardize_format(df: DataFrame, time: str = "time", null_token: str | None = None) -> DataFrame:
    """Parse ``time``, trim and lower text, round fractions to four places with ties to even.

    Missing text stays NULL; ``null_token='nan'`` writes that word instead.
    """
    changed: dict[str, Column] = {}
    if time in df.columns and not isinstance(df.schema[time].dataType, T.TimestampType):
        changed[time] = F.col(time).cast("timestamp")
    for c in text_columns(df.schema, [time]):
        cleaned = trim_lower(F.col(c))
        changed[c] = F.coalesce(cleaned, F.lit(null_token)) if null_token is not None else cleaned
    for c in floating_columns(df.schema, NOT_SCALED):
        changed[c] = half_even(F.col(c), PLACES)
    return df.withColumns(changed) if changed else df
