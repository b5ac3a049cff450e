"""Exact order statistics without sorting the table or holding its distinct values in one task.

A sketch brackets each wanted rank, counts around the bracket are exact, and only the few values inside
go on to the next pass. Ties at a bracket end are settled by the counts, so a value that fills a third
of the table never has to be gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GATHER_ROWS = 10_000
ACCURACY = 10_000
_MARGIN = 2.0 / ACCURACY


def _value(column: str) -> Column:
    return _finite_or_null(F.col(column))


def _finite_or_null(value: Column) -> Column:
    number = value.cast("double")
    return F.when(~F.isnan(number), number)


def _around(shares: list[float]) -> list[float]:
    return sorted({p for s in shares for p in (max(0.0, s - _MARGIN), min(1.0, s + _MARGIN))})


def brackets(columns: list[str], shares: list[float], values: dict[str, Column] | None = None) -> list[Column]:
    """Aggregates that count each column and bracket the shares; ``quantiles`` takes their row as ``seen``.

    They fit into any aggregate over the same rows, also one that is observed while the table is written.
    ``values`` names expressions for columns that are still to be computed.
    """
    found = []
    for c in columns:
        value = _finite_or_null((values or {}).get(c, F.col(c)))
        found += [F.count(value).alias(f"count of {c}"),
                  F.percentile_approx(value, _around(shares), ACCURACY).alias(f"brackets of {c}")]
    return found


def quantiles(df: DataFrame, columns: list[str], shares: list[float], exact: bool = True,
              gather_rows: int = GATHER_ROWS, seen=None) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column, NULL and NaN skipped, all columns per pass.

    ``exact=False`` gives sketch values instead: actual values of the column, one pass. ``seen`` is the row (or dict)
    of ``brackets`` for the same shares, if another pass has it already.
    """
    if not columns:
        return {}
    if not exact:
        row = df.agg(*[
            F.percentile_approx(_value(c), shares, ACCURACY).alias(f"q{i}") for i, c in enumerate(columns)
        ]).first()
        return {c: list(row[f"q{i}"] or [None] * len(shares)) for i, c in enumerate(columns)}
    # One pass counts and brackets each rank: its share is known before the count is.
    row = seen or df.agg(*brackets(columns, shares)).first()
    counts = {c: row[f"count of {c}"] for c in columns}
    first = {c: dict(zip(_around(shares), row[f"brackets of {c}"] or [])) for c in columns}
    ranks = {c: sorted(_ranks(counts[c], shares)) for c in columns if counts[c]}
    likely = {(c, r): (first[c][max(0.0, s - _MARGIN)], first[c][min(1.0, s + _MARGIN)])
              for c in ranks for s in shares for r in _ranks(counts[c], [s])}
    found = order_statistics(df, ranks, counts, gather_rows, likely)
    return {c: [_interpolated(found.get(c, {}), counts[c], s) for s in shares] for c in columns}


def count_values(df: DataFrame, columns: list[str]) -> dict[str, int]:
    row = df.agg(*[F.count(_value(c)).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    return {c: row[f"n{i}"] for i, c in enumerate(columns)}


def _ranks(count: int, shares: list[float]) -> set[int]:
    places = [(count - 1) * s for s in shares]
    return {math.floor(p) for p in places} | {math.ceil(p) for p in places}


def _interpolated(values: dict[int, float], count: int, share: float) -> float | None:
    """Between two ranks the mean weighted by nearness; equal ends as they are, so infinities stay infinite."""
    if not count:
        return None
    place = (count - 1) * share
    low, high = math.floor(place), math.ceil(place)
    if low == high or values[low] == values[high]:
        return values[low]
    return (high - place) * values[low] + (place - low) * values[high]


class _Bracket:
    """An open interval known to hold one rank: ``before`` values lie at or below ``low``."""

    def __init__(self, column: str, rank: int, count: int):
        self.column, self.rank = column, rank
        self.low: float | None = None
        self.high: float | None = None
        self.before, self.inside = 0, count

    def values(self) -> Column:
        value = _value(self.column)
        within = value.isNotNull()
        if self.low is not None:
            within = within & (value > F.lit(self.low))
        if self.high is not None:
            within = within & (value < F.lit(self.high))
        return F.when(within, value)

    def probes(self) -> list[float]:
        share = (self.rank - self.before + 0.5) / self.inside
        return [max(0.0, share - _MARGIN), min(1.0, share + _MARGIN)]

    def narrow(self, left: float, right: float, row, name: str) -> float | None:
        """Move to the part that holds the rank; gives the value when it is one of the probes."""
        lt_left, le_left = row[f"{name}_0"], row[f"{name}_1"]
        lt_right, le_right = row[f"{name}_2"], row[f"{name}_3"]
        if lt_left <= self.rank < le_left:
            return left
        if lt_right <= self.rank < le_right:
            return right
        end = self.before + self.inside
        if self.rank < lt_left:
            self.high, end = left, lt_left
        elif self.rank >= le_right:
            self.low, self.before = right, le_right
        else:
            self.low, self.high, self.before, end = left, right, le_left, lt_right
        self.inside = end - self.before
        return None


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], counts: dict[str, int], gather_rows: int = GATHER_ROWS,
                     likely: dict[tuple[str, int], tuple[float, float]] | None = None) -> dict[str, dict[int, float]]:
    """The values at 0-based ascending ranks, per column. ``likely`` names values around a rank that a sketch gave."""
    found: dict[str, dict[int, float]] = {c: {} for c in ranks}
    open_brackets = [_Bracket(c, r, counts[c]) for c, wanted in ranks.items() for r in wanted]
    likely = dict(likely or {})
    while open_brackets:
        gather = [b for b in open_brackets if b.inside <= gather_rows]
        probe = [b for b in open_brackets if b.inside > gather_rows]
        ends = [likely.pop((b.column, b.rank), None) for b in probe]
        asked = [b for b, known in zip(probe, ends) if known is None]
        # gather_rows bounds each collected list: the count inside the bracket is exact.
        first = [F.element_at(F.array_sort(F.collect_list(b.values())), b.rank - b.before + 1).alias(f"g{i}")
                 for i, b in enumerate(gather)]
        first += [F.percentile_approx(b.values(), b.probes(), ACCURACY).alias(f"p{i}") for i, b in enumerate(asked)]
        row = df.agg(*first).first() if first else None
        for i, b in enumerate(gather):
            found[b.column][b.rank] = row[f"g{i}"]
        if not probe:
            break
        fresh = iter(row[f"p{i}"] for i in range(len(asked))) if asked else iter(())
        ends = [known or next(fresh) for known in ends]
        tests = []
        for i, (b, (left, right)) in enumerate(zip(probe, ends)):
            value = _value(b.column)
            for j, test in enumerate((value < left, value <= left, value < right, value <= right)):
                tests.append(F.count_if(test).alias(f"c{i}_{j}"))
        row = df.agg(*tests).first()
        open_brackets = []
        for i, (b, (left, right)) in enumerate(zip(probe, ends)):
            value = b.narrow(left, right, row, f"c{i}")
            if value is None:
                open_brackets.append(b)
            else:
                found[b.column][b.rank] = value
    return found
