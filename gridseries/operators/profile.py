"""Data quality profiles and descriptive statistics, all columns in one aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.functions.columns import is_infinite
from gridseries.operators.quantiles import brackets, quantiles
from gridseries.schemas import numeric_columns, text_columns

QUARTERS = [0.25, 0.5, 0.75]
DESCRIPTION = ("`column` string, count bigint, mean double, std double, min double, "
               "p25 double, p50 double, p75 double, max double")
TIMES = ("`column` string, count bigint, mean timestamp, min timestamp, p25 timestamp, p50 timestamp, "
         "p75 timestamp, max timestamp")


def is_missing(df: DataFrame, column: str) -> Column:
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.FractionalType):
        return value.isNull() | F.isnan(value)
    return value.isNull()


def _percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)


def _per_column(df: DataFrame, tests: dict[str, Column], total: bool) -> DataFrame:
    """One aggregate over the table, then its single row turned into one row per column."""
    spots = list(enumerate(tests))
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(tests[c]).alias(f"n{i}") for i, c in spots])
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 _percent(F.col(f"n{i}"), F.col("rows")).alias("percent"))
        for i, c in spots
    ]
    if not entries:
        empty = df.sparkSession.createDataFrame([], "position int, `column` string, count bigint, percent double")
        return empty if total else empty.drop("percent")
    rows = totals.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where(F.col("count") > 0)
    return rows if total else rows.drop("percent")


def missing_profile(df: DataFrame) -> DataFrame:
    """``position, column, count, percent`` of the columns with missing values."""
    return _per_column(df, {c: is_missing(df, c) for c in df.columns}, total=True)


def infinity_profile(df: DataFrame) -> DataFrame:
    """``position, column, count`` of the numeric columns that hold infinities."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)]
    return _per_column(df, {c: is_infinite(F.col(c)) for c in floating}, total=False)


def top_missing(df: DataFrame, count: int = 10) -> DataFrame:
    """The columns with the largest missing share, ties in column order."""
    return missing_profile(df).orderBy(F.desc("percent"), "position").limit(count).drop("position")


def duplicate_profile(df: DataFrame) -> DataFrame:
    """Rows beyond the first of equal rows; copies combine before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return groups.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("count"),
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("_rows"),
    ).select("count", _percent(F.col("count"), F.col("_rows")).alias("percent"))


def quality_profile(df: DataFrame) -> dict:
    """Missing values, infinities and duplicates of all columns from one pass: equal rows are combined first.

    ``missing_values``: {column: {count, percent}}, ``inf_values``: {column: count}, both of the columns that have any,
    ``duplicates``: {count, percent}.
    """
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)]
    copies = F.col("_copies")
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    row = groups.agg(
        F.coalesce(F.sum(copies), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct"),
        *[F.sum(F.when(is_missing(df, c), copies)).alias(f"n{i}") for i, c in enumerate(df.columns)],
        *[F.sum(F.when(is_infinite(F.col(c)), copies)).alias(f"i{i}") for i, c in enumerate(floating)]).first()
    rows, again = row["rows"], row["rows"] - row["distinct"]
    return {
        "missing_values": {c: {"count": row[f"n{i}"], "percent": row[f"n{i}"] / rows * 100.0}
                           for i, c in enumerate(df.columns) if row[f"n{i}"]},
        "inf_values": {c: row[f"i{i}"] for i, c in enumerate(floating) if row[f"i{i}"]},
        "duplicates": {"count": again, "percent": again / rows * 100.0 if rows else None},
    }


def dataset_summary(df: DataFrame, time: str = "time") -> DataFrame:
    """Rows, locations, first and last time, number of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("location_id").alias("locations"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    ).withColumn("columns", F.lit(len(df.columns)))


def describe(df: DataFrame, columns: list[str] | None = None, exact: bool = True,
             **selection) -> DataFrame:
    """``column, count, mean, std, min, p25, p50, p75, max`` per numeric column (std with n - 1)."""
    chosen = columns or numeric_columns(df.schema)
    if not chosen:
        return df.sparkSession.createDataFrame([], DESCRIPTION)
    values = {c: F.col(c).cast("double") for c in chosen}
    around = brackets(chosen, QUARTERS) if exact else []
    row = df.agg(*around, *[
        aggregate.alias(f"{name}{i}")
        for i, c in enumerate(chosen)
        for name, aggregate in (
            ("n", F.count(values[c])), ("a", F.avg(values[c])), ("s", F.stddev_samp(values[c])),
            ("l", F.min(values[c])), ("h", F.max(values[c])))
    ]).first()
    quarters = quantiles(df, chosen, QUARTERS, exact, seen=row if exact else None, **selection)
    rows = [
        (c, row[f"n{i}"], row[f"a{i}"], row[f"s{i}"], row[f"l{i}"], *quarters[c], row[f"h{i}"])
        for i, c in enumerate(chosen)
    ]
    return df.sparkSession.createDataFrame(rows, DESCRIPTION)


def column_table(df: DataFrame) -> DataFrame:
    """``position, column, type, rows, known``: the shape of a table, its columns, their types and filled rows."""
    row = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n{i}") for i, c in enumerate(df.columns)]).first()
    rows = [(i, f.name, f.dataType.simpleString(), row["rows"], row[f"n{i}"]) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, `column` string, type string, rows bigint, known bigint")


def describe_times(df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    """``column, count, mean, min, p25, p50, p75, max`` of the time columns, as instants."""
    chosen = columns or [
        f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    if not chosen:
        return df.sparkSession.createDataFrame([], TIMES)
    micros = df.select(*[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in chosen])
    # A mean of doubles this large would be off by microseconds: whole numbers are added up and divided once.
    means = micros.agg(*[F.expr(f"sum(cast(`{c}` as decimal(38,0))) div count(`{c}`)").alias(c) for c in chosen]).first()
    table = describe(micros, chosen, exact)
    exact_mean = F.create_map(*[F.lit(v) for c in chosen for v in (c, means[c])]).cast("map<string,bigint>")
    return table.withColumn("mean", F.try_element_at(exact_mean, F.col("column"))).select("column", "count", *[
        F.timestamp_micros(F.col(c).cast("bigint")).alias(c) for c in ("mean", "min", "p25", "p50", "p75", "max")
    ])


def validation_report(df: DataFrame) -> DataFrame:
    """One row; ``passed`` asks for no missing and no infinite value, duplicates do not fail it.

    Equal rows are combined first, so rows, duplicates, missing and infinite values need one shuffle.
    """
    missing = sum((is_missing(df, c).cast("bigint") for c in df.columns), F.lit(0).cast("bigint"))
    floating = [f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)]
    infinite = sum((F.coalesce(is_infinite(F.col(c)), F.lit(False)).cast("bigint") for c in floating),
                   F.lit(0).cast("bigint"))
    copies = F.col("_copies")
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    totals = groups.agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(n) for n, v in (
        ("total_rows", copies), ("missing_values", copies * missing),
        ("duplicate_rows", copies - 1), ("infinite_values", copies * infinite))])
    return totals.withColumns({
        "total_columns": F.lit(len(df.columns)),
        "numeric_columns": F.lit(len(numeric_columns(df.schema))),
        "categorical_columns": F.lit(len(text_columns(df.schema))),
        "passed": (F.col("missing_values") == 0) & (F.col("infinite_values") == 0),
    })
