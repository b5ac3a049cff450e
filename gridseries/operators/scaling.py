"""Fit and apply scalers; fitted values are a small table of (method, column, stat, value)."""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.operators.quantiles import quantiles
from gridseries.schemas import NOT_SCALED, numeric_columns

METHODS = ("standard", "minmax", "robust")


@dataclass
class Scaler:
    """``(value - center) / scale`` per column."""

    method: str
    centers: dict[str, float]
    scales: dict[str, float]

    def expressions(self) -> dict[str, Column]:
        return {
            c: (F.col(c).cast("double") - F.lit(self.centers[c])) / F.lit(self.scales[c]) for c in self.centers
        }

    def apply(self, df: DataFrame) -> DataFrame:
        absent = [c for c in self.centers if c not in df.columns]
        if absent:
            raise ValueError(f"columns of the fitted scaler are absent: {absent}")
        return df.withColumns(self.expressions())

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (self.method, place, c, stat, float(values[c]))
            for stat, values in (("center", self.centers), ("scale", self.scales))
            for place, c in enumerate(values)
        ]
        return spark.createDataFrame(
            rows, "method string, place int, `column` string, stat string, value double")

    @staticmethod
    def from_frame(frame: DataFrame) -> Scaler:
        rows = sorted(frame.collect(), key=lambda r: r["place"])
        methods = {r["method"] for r in rows}
        if len(methods) != 1:
            raise ValueError(f"one fitted method expected, found {sorted(methods)}")
        return Scaler(
            methods.pop(),
            {r["column"]: r["value"] for r in rows if r["stat"] == "center"},
            {r["column"]: r["value"] for r in rows if r["stat"] == "scale"})


def scalable_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df.schema, NOT_SCALED)


def fit_scaler(df: DataFrame, method: str = "standard", columns: list[str] | None = None,
               exact: bool = True, **selection) -> Scaler:
    """One aggregate over all columns; a column that does not vary gets scale 1. NULLs are skipped."""
    if method not in METHODS:
        raise ValueError(f"unknown scaling method: {method}")
    chosen = columns or scalable_columns(df)
    if not chosen:
        return Scaler(method, {}, {})
    if method == "robust":
        quarters = quantiles(df, chosen, [0.25, 0.5, 0.75], exact, **selection)
        return _scaler(method, {c: (q2, _none_safe(q3, q1)) for c, (q1, q2, q3) in quarters.items()})
    first, second = (F.avg, F.stddev_pop) if method == "standard" else (F.min, F.max)
    row = df.agg(
        *[first(c).alias(f"a{i}") for i, c in enumerate(chosen)],
        *[second(c).alias(f"b{i}") for i, c in enumerate(chosen)],
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(chosen)],
    ).first()
    fitted = {}
    for i, c in enumerate(chosen):
        center, spread = row[f"a{i}"], row[f"b{i}"]
        if method == "minmax":
            spread = _none_safe(spread, center)
        elif spread is not None and _constant(spread, center, row[f"n{i}"]):
            spread = 0.0
        fitted[c] = (center, spread)
    return _scaler(method, fitted)


def _none_safe(high, low):
    return None if high is None or low is None else float(high) - float(low)


def _constant(deviation: float, mean: float, count: int) -> bool:
    """Whether the variance is no more than the rounding error of computing it."""
    eps = sys.float_info.epsilon
    variance = deviation * deviation
    return variance <= count * eps * variance + (count * mean * eps) ** 2


def _scaler(method: str, fitted: dict[str, tuple[float | None, float | None]]) -> Scaler:
    tiny = 10 * sys.float_info.epsilon
    centers, scales = {}, {}
    for c, (center, spread) in fitted.items():
        centers[c] = math.nan if center is None else float(center)
        scales[c] = 1.0 if spread is None or spread < tiny else float(spread)
    return Scaler(method, centers, scales)


def scale_features(df: DataFrame, method: str = "standard", columns: list[str] | None = None,
                   scaler: Scaler | None = None) -> tuple[DataFrame, Scaler]:
    """Fit and apply, or apply a fitted scaler of the same method."""
    if scaler is None:
        scaler = fit_scaler(df, method, columns)
    elif scaler.method != method:
        raise ValueError(f"scaler was fitted as {scaler.method}, not {method}")
    return scaler.apply(df), scaler
