"""Fill or drop missing values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.functions.columns import INFINITY, nan_to_null
from gridseries.operators.ordered import BLOCK_ROWS, forward_fill, interpolate
from gridseries.operators.quantiles import brackets, quantiles
from gridseries.schemas import NOT_MEASURED, numeric_columns, text_columns
from gridseries.session import materialize_observed

MEDIAN = [0.5]
STRATEGIES = ("smart", "mean", "median", "mode", "forward_fill", "interpolate", "drop")


def fill_missing(df: DataFrame, strategy: str = "smart", order_by: list[str] | None = None,
                 fill_value=None, group_by: str = "location_id", time: str = "time",
                 fill_text_within: str | None = None, exact: bool = True,
                 block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Fill by ``strategy``; a table without missing values comes back as it is.

    Spark rows have no order of their own: ``order_by`` names columns that give one. ``smart``
    puts (location, time) before them and needs them only where those have ties. Text runs on from
    one location to the next unless ``fill_text_within`` names the group.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy: {strategy}")
    df = nan_to_null(df)
    if strategy == "drop":
        return df.dropna("any")
    if strategy == "smart":
        return _fill_smart(df, order_by or [], group_by, time, fill_text_within, exact, block_rows)
    missing = missing_counts(df)
    gaps = [c for c in df.columns if missing[c]]
    if not gaps:
        return df
    numeric = [c for c in numeric_columns(df.schema) if c in gaps]
    if strategy == "mean":
        return fill_with(df, means(df, numeric))
    if strategy == "median":
        return fill_with(df, medians(df, numeric, exact))
    if strategy == "mode":
        found = modes(df, gaps)
        return fill_with(df, {c: fill_value if found[c] is None else found[c] for c in gaps})
    if not order_by:
        raise ValueError(f"{strategy} needs order_by: columns that order the whole table")
    if strategy == "forward_fill":
        return forward_fill(df, gaps, [], order_by, block_rows)
    return nan_to_null(interpolate(df, numeric, [], order_by, block_rows))


def missing_counts(df: DataFrame) -> dict[str, int]:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(df.columns)}


def means(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    if not columns:
        return {}
    row = df.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}


def medians(df: DataFrame, columns: list[str], exact: bool = True, seen=None) -> dict[str, float | None]:
    return {c: q[0] for c, q in quantiles(df, columns, MEDIAN, exact, seen=seen).items()}


def modes(df: DataFrame, columns: list[str]) -> dict:
    """The most frequent value per column, the smallest of equally frequent ones, None without values.

    Values are counted by (column, value), with partial sums, rather than in one map per column.
    """
    found = {c: None for c in columns}
    by_type: dict[T.DataType, list[str]] = {}
    for c in columns:
        by_type.setdefault(df.schema[c].dataType, []).append(c)
    for same in by_type.values():
        entries = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in same]))
        counts = (
            df.select(entries.alias("e")).where(F.col("e.v").isNotNull())
            .groupBy("e.c", "e.v").agg(F.count(F.lit(1)).alias("n"))
        )
        best = counts.groupBy("c").agg(F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("v"))
        found.update({r["c"]: r["v"] for r in best.collect()})
    return found


def fill_with(df: DataFrame, values: dict) -> DataFrame:
    """Replace NULLs by constants; a whole-number column filled with a fraction becomes double."""
    return df.withColumns({c: _filled(df, c, v) for c, v in values.items() if v is not None})


def _filled(df: DataFrame, column: str, value) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.IntegralType) and isinstance(value, float):
        return F.coalesce(F.col(column).cast("double"), F.lit(value))
    return F.coalesce(F.col(column), F.lit(value).cast(kind))


def _fill_smart(df, order_by, group_by, time, fill_text_within, exact, block_rows) -> DataFrame:
    """Interpolate measures, run text forward then take the mode, then medians for what is left."""
    located = group_by in df.columns and time in df.columns
    if not located and not order_by:
        raise ValueError("order_by is needed where the table has no location and time")
    keys = [group_by] if located else []
    order = ([time] if located else []) + order_by
    gaps, may_stay = _survey(df, keys)
    if not gaps:
        return df
    numeric = [c for c in numeric_columns(df.schema) if c in gaps]
    measures = [c for c in numeric if c not in NOT_MEASURED]
    others = [c for c in numeric if c in NOT_MEASURED]
    text = [c for c in text_columns(df.schema) if c in gaps]
    other_medians = medians(df, others, exact)
    # Text that runs on from the first row of the table leaves no gap, so needs no mode.
    leading = text if fill_text_within else _without_first(df, text, keys + order)
    text_modes = modes(df, leading)

    filled = nan_to_null(interpolate(df, measures, keys, order, block_rows), measures)
    undecided = [c for c in measures if c in may_stay]
    if undecided:
        # Medians of the interpolated values: store them once instead of sorting again per pass.
        filled, seen = materialize_observed(filled, "interpolated", brackets(undecided, MEDIAN) if exact else [])
        filled = fill_with(filled, medians(filled, undecided, exact, seen))
    filled = fill_with(filled, other_medians)
    if text:
        within = [fill_text_within] if fill_text_within else []
        rest = [c for c in keys + order if c not in within]
        filled = forward_fill(filled, text, within, rest, block_rows)
        filled = fill_with(filled, {c: "Unknown" if text_modes[c] is None else text_modes[c] for c in leading})
    return filled


def _survey(df: DataFrame, keys: list[str]) -> tuple[set[str], set[str]]:
    """The columns with gaps, and the numbers among which interpolation may leave some, because a group
    has no value or both infinities. One pass of counts and extremes by group, combined in hash tables."""
    columns = df.columns
    numbers = set(numeric_columns(df.schema))
    per_group = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(columns):
        per_group.append(F.count(c).alias(f"n{i}"))
        if c in numbers:
            per_group += [F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
    totals = []
    for i, c in enumerate(columns):
        totals.append(F.sum(F.col("rows") - F.col(f"n{i}")).alias(f"gap{i}"))
        if c in numbers:
            infinite = (F.col(f"l{i}") == -INFINITY) & (F.col(f"h{i}") == INFINITY)
            totals.append(F.max((F.col(f"n{i}") == 0) | F.coalesce(infinite, F.lit(False))).alias(f"stay{i}"))
    row = df.groupBy(*keys).agg(*per_group).agg(*totals).first()
    return (
        {c for i, c in enumerate(columns) if row[f"gap{i}"]},
        {c for i, c in enumerate(columns) if c in numbers and row[f"stay{i}"]})


def _without_first(df: DataFrame, text: list[str], order: list[str]) -> list[str]:
    """The text columns that are NULL in the first row; each task passes on one row."""
    if not text:
        return []
    row = df.select(*order, *[F.col(c).isNull().alias(f"_no_{c}") for c in text]).orderBy(*order).limit(1).first()
    return [c for c in text if row is not None and row[f"_no_{c}"]]
