"""Order-dependent operators (lag, fills, interpolation, positions) that split hot groups.

A plain window sends every row of a group to one task. Here, once a group has more than ``block_rows`` rows, the table is
range-partitioned by keys and order and stored with the number of each row's range. Each range is a window partition of
its own, and what a range needs from its neighbours (a last value, a tail of rows, a row count) comes from a summary
with one row per range of the groups that lie in several ranges: about as many rows as there are ranges. Ranges take all
order columns, of any type that Spark sorts, and at last the row itself, so equal order values are cut as well.

The ranges are stored before they are used, so a lost and recomputed task finds each row in the same range again.
``block_rows=None`` says that the caller knows the groups to be small; a whole table is never taken for one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from gridseries.session import materialize

BLOCK_ROWS = 2_000_000
_BLOCK, _TIE = "_block0", "_tie"


@dataclass
class Ranges:
    """A frame with range numbers in ``blocks`` (no block columns: nothing is hot)."""

    df: DataFrame
    keys: list[str]
    order: list[str]
    blocks: list[str]

    def window(self) -> WindowSpec:
        parts = [F.col(c) for c in self.keys + self.blocks] or [F.lit(0)]
        return Window.partitionBy(*parts).orderBy(*self.order)

    def earlier(self) -> WindowSpec:
        """Over the summary: the ranges before this one."""
        return self._across().rowsBetween(Window.unboundedPreceding, -1)

    def later(self) -> WindowSpec:
        """Over the summary, in reverse: the ranges after this one, the nearest last."""
        return self._across(reverse=True).rowsBetween(Window.unboundedPreceding, -1)

    def _across(self, reverse: bool = False) -> WindowSpec:
        parts = [F.col(c) for c in self.keys] or [F.lit(0)]
        return Window.partitionBy(*parts).orderBy(*[F.desc(c) if reverse else F.asc(c) for c in self.blocks])

    def hot_rows(self) -> DataFrame:
        """The rows of groups in several ranges; there are fewer of those groups than ranges."""
        if not self.keys:
            return self.df
        spans = self.df.groupBy(*self.keys).agg(F.min(_BLOCK).alias("_from"), F.max(_BLOCK).alias("_to")).where(
            "_from < _to").select(*[F.col(c).alias(f"_s_{c}") for c in self.keys])
        return self.df.join(spans, self._match(self.keys), "left_semi")

    def attach(self, summary: DataFrame, carried: list[str]) -> DataFrame:
        """Bring the carried columns of the summary to every row."""
        names = self.keys + self.blocks
        renamed = summary.select(*[F.col(c).alias(f"_s_{c}") for c in names], *carried)
        return self.df.join(renamed, self._match(names), "left").drop(*[f"_s_{c}" for c in names])

    @staticmethod
    def _match(names: list[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in names])

    def done(self, df: DataFrame, *scratch: str) -> DataFrame:
        return df.drop(*self.blocks, *scratch)


def split_hot(df: DataFrame, keys: list[str], order: list[str],
              block_rows: int | None = BLOCK_ROWS) -> Ranges:
    """Number the ranges, in order, if any group has more than ``block_rows`` rows."""
    missing = [c for c in keys + order if c not in df.columns]
    if missing:
        raise ValueError(f"unknown key or order columns: {missing}")
    if block_rows is None:
        if not keys:
            raise ValueError("a whole table is no small group: give block_rows")
        return Ranges(df, keys, order, [])
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.agg(F.max("_n").alias("largest"), F.sum("_n").alias("rows")).first()
    if (sizes["largest"] or 0) <= block_rows:
        return Ranges(df, keys, order, [])
    # Ranges of half a block on average: they come from a sample, so some get larger.
    pieces = math.ceil(2 * sizes["rows"] / block_rows)
    placed = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(pieces, *keys, *order, _TIE)
        .withColumn(_BLOCK, F.spark_partition_id()).drop(_TIE)
    )
    return Ranges(materialize(placed, "ranges"), keys, order, [_BLOCK])


def add_positions(df: DataFrame, name: str, keys: list[str], order: list[str],
                  block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """1-based row positions per group in order (the whole table without keys)."""
    ranges = split_hot(df, keys, order, block_rows)
    local = F.row_number().over(ranges.window()).cast("long")
    if not ranges.blocks:
        return ranges.df.withColumn(name, local)
    sizes = (
        ranges.hot_rows().groupBy(*keys, *ranges.blocks).agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(ranges.earlier()), F.lit(0)))
    )
    placed = ranges.attach(sizes, ["_before"])
    placed = placed.withColumn(name, local + F.coalesce("_before", F.lit(0)))
    return ranges.done(placed, "_before")


def lag_columns(df: DataFrame, lags: dict[str, tuple[str, int]], keys: list[str], order: list[str],
                block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Add ``name -> (column, n)``: the value ``n`` row positions earlier in the group."""
    ranges = split_hot(df, keys, order, block_rows)
    window = ranges.window()
    if not ranges.blocks:
        return ranges.df.withColumns({name: F.lag(c, n).over(window) for name, (c, n) in lags.items()})
    deepest = max(n for _, n in lags.values())
    columns = sorted({c for c, _ in lags.values()})
    backward = Window.partitionBy(*keys, *ranges.blocks).orderBy(*[F.desc(c) for c in order])
    # A tail holds at most ``deepest`` rows; row_number() <= n is cut down before the shuffle.
    tails = (
        ranges.hot_rows().withColumn("_back", F.row_number().over(backward))
        .where(F.col("_back") <= deepest)
        .groupBy(*keys, *ranges.blocks)
        .agg(F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("_at"), *columns))).alias("_tail"))
        .withColumn("_joined", F.flatten(F.collect_list("_tail").over(
            ranges._across().rowsBetween(-deepest, -1))))
        .withColumn("_carry", F.slice(
            "_joined", F.greatest(F.size("_joined") - deepest + 1, F.lit(1)), F.lit(deepest)))
    )
    placed = ranges.attach(tails, ["_carry"]).withColumn("_rn", F.row_number().over(window))

    def earlier_value(column: str, n: int) -> Column:
        from_tail = F.get("_carry", F.size("_carry") - n + F.col("_rn") - 1)[column]
        return F.when(F.col("_rn") > n, F.lag(column, n).over(window)).otherwise(from_tail)

    placed = placed.withColumns({name: earlier_value(c, n) for name, (c, n) in lags.items()})
    return ranges.done(placed, "_carry", "_rn")


def forward_fill(df: DataFrame, columns: list[str], keys: list[str], order: list[str],
                 block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Replace NULL by the last value before it; leading NULLs stay."""
    ranges = split_hot(df, keys, order, block_rows)
    running = ranges.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if not ranges.blocks:
        return ranges.df.withColumns({c: F.last(c, ignorenulls=True).over(running) for c in columns})
    position = F.struct(*order)
    last_of = [
        F.max_by(c, F.when(F.col(c).isNotNull(), position)).alias(f"_last_{i}")
        for i, c in enumerate(columns)
    ]
    carried = [f"_carry_{i}" for i in range(len(columns))]
    ends = (
        ranges.hot_rows().groupBy(*keys, *ranges.blocks).agg(*last_of)
        .withColumns({
            f"_carry_{i}": F.last(f"_last_{i}", ignorenulls=True).over(ranges.earlier())
            for i in range(len(columns))
        })
    )
    placed = ranges.attach(ends, carried)
    placed = placed.withColumns({
        c: F.coalesce(F.last(c, ignorenulls=True).over(running), F.col(f"_carry_{i}"))
        for i, c in enumerate(columns)
    })
    return ranges.done(placed, *carried)


def interpolate(df: DataFrame, columns: list[str], keys: list[str], order: list[str],
                block_rows: int | None = BLOCK_ROWS) -> DataFrame:
    """Linear interpolation by row position; the ends take the nearest value; all-NULL groups stay."""
    if not columns:
        return df
    ranges = split_hot(df, keys, order, block_rows)
    window = ranges.window()
    before = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    frame = ranges.df.withColumn("_rn", F.row_number().over(window).cast("long"))
    carried: list[str] = []
    if ranges.blocks:
        ranges = Ranges(frame, keys, order, ranges.blocks)
        frame, carried = _with_neighbours(ranges, columns)
    # The next known point is the last one in reverse order: a frame that ends at the end of the
    # partition would be scanned again for every row.
    after = (
        Window.partitionBy(*[F.col(c) for c in keys + ranges.blocks] or [F.lit(0)]).orderBy(F.desc("_rn"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    known = {c: _known(c) for c in columns}
    previous = {f"_p{i}": F.last(known[c], ignorenulls=True).over(before) for i, c in enumerate(columns)}
    following = {f"_q{i}": F.last(known[c], ignorenulls=True).over(after) for i, c in enumerate(columns)}
    frame = frame.withColumns({**previous, **following})
    if carried:
        frame = frame.withColumns({
            **{f"_p{i}": F.coalesce(f"_p{i}", f"_cp{i}") for i in range(len(columns))},
            **{f"_q{i}": F.coalesce(f"_q{i}", f"_cq{i}") for i in range(len(columns))},
        })
    frame = frame.withColumns({c: _between(c, f"_p{i}", f"_q{i}") for i, c in enumerate(columns)})
    scratch = [f"_p{i}" for i in range(len(columns))] + [f"_q{i}" for i in range(len(columns))]
    return ranges.done(frame, "_rn", *scratch, *carried)


def _known(column: str) -> Column:
    return F.when(F.col(column).isNotNull(),
                  F.struct(F.col("_rn").alias("at"), F.col(column).cast("double").alias("y")))


def _with_neighbours(ranges: Ranges, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """Group-wide positions in ``_rn`` and, per column, the known points around each range."""
    spots = range(len(columns))
    ends = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(columns):
        ends += [F.min(_known(c)).alias(f"_first{i}"), F.max(_known(c)).alias(f"_last{i}")]
    summary = (
        ranges.hot_rows().groupBy(*ranges.keys, *ranges.blocks).agg(*ends)
        .withColumn("_before", F.coalesce(F.sum("_rows").over(ranges.earlier()), F.lit(0)))
    )

    def shifted(name: str) -> Column:
        point = F.col(name)
        return F.when(point.isNotNull(),
                      F.struct((point["at"] + F.col("_before")).alias("at"), point["y"].alias("y")))

    summary = summary.withColumns({
        **{f"_first{i}": shifted(f"_first{i}") for i in spots},
        **{f"_last{i}": shifted(f"_last{i}") for i in spots},
    })
    summary = summary.withColumns({
        **{f"_cp{i}": F.last(f"_last{i}", ignorenulls=True).over(ranges.earlier()) for i in spots},
        **{f"_cq{i}": F.last(f"_first{i}", ignorenulls=True).over(ranges.later()) for i in spots},
    })
    carried = ["_before"] + [f"_cp{i}" for i in spots] + [f"_cq{i}" for i in spots]
    frame = ranges.attach(summary, carried)
    return frame.withColumn("_rn", F.col("_rn") + F.coalesce("_before", F.lit(0))), carried


def _between(column: str, before: str, after: str) -> Column:
    """The point on the line between the known neighbours, also where one of them is infinite."""
    at, p, q = F.col("_rn"), F.col(before), F.col(after)
    slope = (q["y"] - p["y"]) / (q["at"] - p["at"]).cast("double")
    from_left = slope * (at - p["at"]) + p["y"]
    from_right = slope * (at - q["at"]) + q["y"]
    value = (
        F.when(~F.isnan(from_left), from_left)
        .when(~F.isnan(from_right), from_right)
        .when(p["y"] == q["y"], p["y"])
    )
    return (
        F.when(F.col(column).isNotNull(), F.col(column).cast("double"))
        .when(p.isNotNull() & q.isNotNull(), value)
        .otherwise(F.coalesce(p["y"], q["y"]))
    )
