"""Handle infinite values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.functions.columns import clip, is_infinite, nan_to_null
from gridseries.operators.missing import MEDIAN, fill_with, medians
from gridseries.operators.quantiles import brackets
from gridseries.schemas import floating_columns

STRATEGIES = ("replace", "drop", "clip")


def infinite_columns(df: DataFrame) -> list[str]:
    floating = floating_columns(df.schema)
    if not floating:
        return []
    row = df.agg(*[F.max(is_infinite(F.col(c))).alias(f"n{i}") for i, c in enumerate(floating)]).first()
    return [c for i, c in enumerate(floating) if row[f"n{i}"]]


def _finite(df: DataFrame) -> dict[str, Column]:
    return {c: F.when(~is_infinite(F.col(c)), F.col(c)) for c in floating_columns(df.schema)}


def infinity_metrics(df: DataFrame, strategy: str = "replace", exact: bool = True) -> list[Column]:
    """The aggregates that ``handle_infinite`` needs of the table, to be observed while it is written."""
    finite = _finite(df)
    return [
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(is_infinite(F.col(c))).alias(f"n{i}") for i, c in enumerate(finite)],
        *[F.min(v).alias(f"l{i}") for i, v in enumerate(finite.values())],
        *[F.max(v).alias(f"h{i}") for i, v in enumerate(finite.values())],
        *(brackets(list(finite), MEDIAN, finite) if strategy == "replace" and exact else [])]


def handle_infinite(df: DataFrame, strategy: str = "replace", exact: bool = True, seen=None) -> DataFrame:
    """``replace`` fills all gaps of a column that held infinities with its median, ``drop`` removes
    rows with an infinite or missing value in any column, ``clip`` uses the finite extremes.
    ``seen`` holds the ``infinity_metrics`` of the table where a pass has taken them already."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    df = nan_to_null(df)
    floating = floating_columns(df.schema)
    finite = _finite(df)
    row = seen or df.agg(*infinity_metrics(df, strategy, exact)).first()
    held = {c: i for i, c in enumerate(floating) if row[f"n{i}"]}
    if not held:
        return df
    if strategy == "clip":
        return df.withColumns({
            c: clip(F.col(c), row[f"l{i}"], row[f"h{i}"]) for c, i in held.items() if row[f"l{i}"] is not None})
    cleared = df.withColumns({c: finite[c] for c in held})
    if strategy == "drop":
        return cleared.dropna("any")
    return fill_with(cleared, medians(cleared, list(held), exact, row if exact else None))
