"""Remove duplicate rows. Every form is a grouped aggregate, so copies of a row combine before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def remove_duplicates(df: DataFrame, subset: list[str] | None = None, keep: str | bool = "first",
                      order_by: list[str] | None = None) -> DataFrame:
    """Keep the first, the last or (``keep=False``) none of the rows that agree on ``subset``.

    With a subset, ``order_by`` says which row is first; all columns break ties. NULLs are equal, as are NaNs.
    """
    if keep not in ("first", "last", False):
        raise ValueError(f"unknown keep: {keep}")
    if subset is None or set(subset) == set(df.columns):
        if keep is not False:
            return df.dropDuplicates()
        groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
        return groups.where("_copies = 1").drop("_copies")
    row = F.struct(*df.columns)
    if keep is False:
        groups = df.groupBy(*[F.col(c).alias(f"_k_{c}") for c in subset]).agg(
            F.count(F.lit(1)).alias("_copies"), F.any_value(row).alias("_row"))
        return groups.where("_copies = 1").select("_row.*")
    if not order_by:
        raise ValueError("order_by is needed to tell the first row from the last")
    place = F.struct(*order_by, *[c for c in df.columns if c not in order_by])
    pick = F.min_by if keep == "first" else F.max_by
    groups = df.groupBy(*[F.col(c).alias(f"_k_{c}") for c in subset]).agg(pick(row, place).alias("_row"))
    return groups.select("_row.*")
