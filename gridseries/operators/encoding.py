"""Fit and apply encoders for text columns; fitted categories are a table of (column, category, code)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.operators.joins import lookup_join
from gridseries.operators.ordered import BLOCK_ROWS, add_positions
from gridseries.schemas import NOT_ENCODED, text_columns
from gridseries.session import materialize

# Up to this many categories of a column become a constant in the plan; more are joined.
LITERAL_CATEGORIES = 1000
# More 0/1 columns of one source column than this are an error: such a table is asked for as vectors.
ONEHOT_COLUMNS = 500
FORMS = ("columns", "vector")

METHODS = ("onehot", "label")


def encodable_columns(df: DataFrame) -> list[str]:
    return text_columns(df.schema, NOT_ENCODED)


def fit_categories(df: DataFrame, columns: list[str] | None = None, null_token: str | None = None,
                   block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """``column, category, code``: codes from 0 in byte order of the categories of each column.

    ``null_token`` counts missing text as that word; otherwise NULL is no category.
    """
    chosen = columns or encodable_columns(df)
    if not chosen:
        return df.sparkSession.createDataFrame([], "`column` string, category string, code bigint")
    entries = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), _token(c, null_token).alias("category")) for c in chosen]))
    distinct = (
        df.select(entries.alias("e")).select("e.*").where(F.col("category").isNotNull()).distinct()
    )
    # Stored once: the positions read it again, and computing it scans the whole table.
    distinct = materialize(distinct, "distinct-categories")
    numbered = add_positions(distinct, "_row", ["column"], ["category"], block_rows)
    return numbered.select("column", "category", (F.col("_row") - 1).alias("code"))


def _token(column: str, null_token: str | None) -> Column:
    value = F.col(column).cast("string")
    return F.coalesce(value, F.lit(null_token)) if null_token is not None else value


def fitted_columns(categories: DataFrame) -> list[str]:
    return sorted(r["column"] for r in categories.select("column").distinct().collect())


def apply_labels(df: DataFrame, categories: DataFrame, columns: list[str] | None = None,
                 null_token: str | None = None, unknown: str = "error") -> DataFrame:
    """Replace each column by its code; an unknown value is an error (or NULL with ``unknown='null'``)."""
    if unknown not in ("error", "null"):
        raise ValueError(f"unknown must be error or null: {unknown}")
    listed: dict[str, list] = {c: [] for c in columns or []}
    # At most LITERAL_CATEGORIES + 1 rows per column reach the driver.
    for row in categories.where(F.col("code") <= LITERAL_CATEGORIES).collect():
        listed.setdefault(row["column"], []).append(row)
    for c in columns or sorted(listed):
        few = listed[c]
        df = df.withColumn("_category", _token(c, null_token))
        if not few:
            code = F.lit(None).cast("bigint")
        elif len(few) <= LITERAL_CATEGORIES:
            pairs = F.create_map(*[F.lit(v) for r in few for v in (r["category"], int(r["code"]))])
            code = F.try_element_at(pairs, F.col("_category")).cast("bigint")
        else:
            renamed = categories.where(F.col("column") == c).select(
                F.col("category").alias("_category"), F.col("code").alias("_code"))
            df = lookup_join(df, renamed, ["_category"])
            code = F.col("_code")
        if unknown == "error":
            problem = F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.col("_category")))
            code = F.when(code.isNull() & F.col("_category").isNotNull(), problem.cast("bigint")).otherwise(code)
        df = df.withColumn(c, code).drop("_category", "_code")
    return df


def onehot_categories(categories: DataFrame, most: int = ONEHOT_COLUMNS) -> dict[str, list[str]]:
    """The categories that get a 0/1 column: all but the first of each source column."""
    sizes = {r["column"]: r["n"] for r in categories.groupBy("column").agg(F.max("code").alias("n")).collect()}
    large = sorted(c for c, n in sizes.items() if n > most)
    if large:
        raise ValueError(f"more than {most} 0/1 columns for each of {large}: ask for the form 'vector'")
    kept: dict[str, list[str]] = {c: [] for c in sorted(sizes)}
    # At most ``most`` rows per column reach the driver.
    for row in categories.where(F.col("code") > 0).orderBy("column", "code").collect():
        kept[row["column"]].append(row["category"])
    return kept


def apply_onehot(df: DataFrame, categories: DataFrame, form: str = "columns", most: int = ONEHOT_COLUMNS) -> DataFrame:
    """The stored categories one-hot, in the form that the caller names, whatever their number; the source columns go.

    ``columns`` gives 0/1 columns ``<column>_<category>``, NULL and unknown give 0. ``vector`` gives ``<column>_onehot``: size,
    indices and values of a sparse vector, index 0 for the second category; NULL and unknown give an empty one.
    """
    if form not in FORMS:
        raise ValueError(f"unknown one-hot form: {form}")
    if form == "columns":
        kept = onehot_categories(categories, most)
        added = {
            f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for c, values in kept.items() for v in values
        }
        return (df.withColumns(added) if added else df).drop(*kept)
    sizes = {r["column"]: r["n"] for r in categories.groupBy("column").agg(F.max("code").alias("n")).collect()}
    for c, size in sorted(sizes.items()):
        renamed = categories.where(F.col("column") == c).select(F.col("category").alias(c), (F.col("code") - 1).alias("_at"))
        hot = F.col("_at") >= 0
        vector = F.struct(
            F.lit(size).cast("bigint").alias("size"),
            F.when(hot, F.array("_at")).otherwise(F.array().cast("array<bigint>")).alias("indices"),
            F.when(hot, F.array(F.lit(1.0))).otherwise(F.array().cast("array<double>")).alias("values"))
        df = lookup_join(df, renamed, [c]).withColumn(f"{c}_onehot", vector).drop(c, "_at")
    return df


def encode_categorical(df: DataFrame, method: str = "onehot", columns: list[str] | None = None,
                       categories: DataFrame | None = None, form: str = "columns") -> tuple[DataFrame, DataFrame]:
    """Fit (without ``categories``) and apply; gives the frame and the fitted table."""
    if method not in METHODS:
        raise ValueError(f"unknown encoding method: {method}")
    if categories is None:
        categories = fit_categories(df, columns)
    elif columns is not None:
        unfitted = set(columns) - set(fitted_columns(categories))
        if unfitted:
            raise ValueError(f"columns were never fitted: {sorted(unfitted)}")
        categories = categories.where(F.col("column").isin(columns))
    encoded = apply_onehot(df, categories, form) if method == "onehot" else apply_labels(df, categories)
    return encoded, categories
