"""Text expressions that the operators of this package share. All of them take null as empty text."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does the same on pure ASCII and is much faster."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(
        F.lower(text))


def words(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(whole(text), F.lit(pattern), F.lit(0))


def let(value: Column, use) -> Column:
    """Compute a value once per row and use it many times, also inside lambda functions."""
    return F.transform(F.array(value), use)[0]


def shingles(of: Column, length: int) -> Column:
    """Space-joined runs of ``length`` words; a shorter text is one shingle, no words give none."""
    return let(of, lambda w: F.when(F.size(w) == 0, F.array().cast("array<string>"))
               .when(F.size(w) <= length, F.array(F.array_join(w, " ")))
               .otherwise(F.transform(F.sequence(F.lit(0), F.size(w) - length),
                                      lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(length)]))))


def free_name(taken: list[str], name: str) -> str:
    """A column name that no column has yet, whatever its case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name
