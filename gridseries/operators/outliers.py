"""Detect and treat outliers."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.functions.columns import clip
from gridseries.operators.quantiles import count_values, order_statistics, quantiles
from gridseries.schemas import NOT_MEASURED, numeric_columns

TREATMENTS = ("clip", "remove", "winsorize", "log_transform")
TAIL = 0.05
QUARTILES = [0.25, 0.75]


@dataclass(frozen=True)
class Outliers:
    """Findings for one column; ``bounded`` says whether clip and remove may use the bounds."""

    column: str
    count: int
    percent: float
    lower: float
    upper: float
    bounded: bool = True


def measured_columns(df: DataFrame) -> list[str]:
    return numeric_columns(df.schema, NOT_MEASURED)


def detect_outliers(df: DataFrame, method: str = "iqr", threshold: float = 3.0,
                    columns: list[str] | None = None, exact: bool = True,
                    reference_compat: bool = True, seen=None) -> list[Outliers]:
    """Columns with values strictly beyond the bounds, in column order.

    ``iqr``: quartiles widened by ``threshold`` ranges. ``zscore``: more than ``threshold`` population
    deviations from the mean; its bounds are usable only with ``reference_compat=False``. ``seen`` holds the
    ``brackets`` of the quartiles where an earlier pass has taken them.
    """
    chosen = columns or measured_columns(df)
    if not chosen:
        return []
    if method == "iqr":
        bounds = _iqr_bounds(df, chosen, threshold, exact, seen)
        beyond = {c: (F.col(c) < low) | (F.col(c) > high) for c, (low, high) in bounds.items()}
    elif method == "zscore":
        moments = _moments(df, chosen)
        bounds = {c: (m - threshold * s, m + threshold * s) for c, (m, s) in moments.items()}
        beyond = {c: F.abs(F.col(c) - m) / F.lit(s) > threshold for c, (m, s) in moments.items()}
    else:
        raise ValueError(f"unknown method: {method}")
    if not bounds:
        return []
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(beyond[c]).alias(f"n{i}") for i, c in enumerate(bounds)],
    ).first()
    bounded = method == "iqr" or not reference_compat
    return [
        Outliers(c, row[f"n{i}"], row[f"n{i}"] / row["rows"] * 100, *bounds[c], bounded)
        for i, c in enumerate(bounds) if row[f"n{i}"]
    ]


def _iqr_bounds(df, columns, threshold, exact, seen) -> dict[str, tuple[float, float]]:
    bounds = {}
    for c, (q1, q3) in quantiles(df, columns, QUARTILES, exact, seen=seen).items():
        if q1 is not None:
            bounds[c] = (q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1))
    return bounds


def _moments(df, columns) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; columns that do not vary or hold infinities have no z-score."""
    row = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns)],
    ).first()
    moments = {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}
    return {c: (m, s) for c, (m, s) in moments.items() if s is not None and s > 0 and s != float("inf")}


def outlier_frame(spark: SparkSession, found: list[Outliers]) -> DataFrame:
    rows = [(o.column, o.count, o.percent, o.lower, o.upper) for o in found]
    return spark.createDataFrame(
        rows, "`column` string, count bigint, percent double, lower_bound double, upper_bound double")


def top_outliers(spark: SparkSession, found: list[Outliers], count: int = 10) -> DataFrame:
    return outlier_frame(spark, found).orderBy(F.desc("count"), "column").limit(count)


def flag_outliers(df: DataFrame, found: list[Outliers]) -> DataFrame:
    """``<column>_outlier`` per found column; NULL values are no outliers."""
    return df.withColumns({
        f"{o.column}_outlier": F.coalesce((F.col(o.column) < o.lower) | (F.col(o.column) > o.upper), F.lit(False))
        for o in found
    })


def treat_outliers(df: DataFrame, method: str = "clip", found: list[Outliers] | None = None,
                   detection_method: str = "iqr", threshold: float = 3.0, exact: bool = True,
                   reference_compat: bool = True, logged: list[str] | None = None) -> DataFrame:
    """Clip to the bounds, remove rows beyond them (NULLs too), winsorize 5 % per tail, or add logs.

    Logs are added to found columns whose values are all above zero. ``logged`` names columns that get theirs whatever they
    hold: NULL where a value is missing, or -1 or less.
    """
    if method not in TREATMENTS:
        raise ValueError(f"unknown method: {method}")
    if found is None:
        found = detect_outliers(df, detection_method, threshold, None, exact, reference_compat)
    if method == "log_transform":
        return _with_logs(df, [o.column for o in found], logged or [])
    if not found:
        return df
    usable = [o for o in found if o.bounded]
    if method == "clip":
        return df.withColumns({o.column: clip(F.col(o.column), o.lower, o.upper) for o in usable}) if usable else df
    if method == "remove":
        inside = [(F.col(o.column) >= o.lower) & (F.col(o.column) <= o.upper) for o in usable]
        return df.where(reduce(lambda a, b: a & b, inside)) if usable else df
    return winsorize(df, [o.column for o in found])


def _with_logs(df: DataFrame, columns: list[str], always: list[str]) -> DataFrame:
    chosen = set(always)
    if asked := [c for c in columns if c not in chosen]:
        row = df.agg(*[F.every(F.coalesce(F.col(c) > 0, F.lit(False))).alias(f"a{i}")
                       for i, c in enumerate(asked)]).first()
        chosen |= {c for i, c in enumerate(asked) if row[f"a{i}"]}
    logs = {f"{c}_log": F.log1p(c) for c in dict.fromkeys([*columns, *always]) if c in chosen}
    return df.withColumns(logs) if logs else df


def winsorize(df: DataFrame, columns: list[str], tail: float = TAIL, **selection) -> DataFrame:
    """Clamp to the values at the ascending positions ``int(tail * n)`` from either end."""
    counts = count_values(df, columns)
    ranks = {c: [int(tail * n), n - 1 - int(tail * n)] for c, n in counts.items() if n}
    values = order_statistics(df, {c: sorted(set(r)) for c, r in ranks.items()}, counts, **selection)
    return df.withColumns({c: clip(F.col(c), values[c][low], values[c][high]) for c, (low, high) in ranks.items()})
