"""Benchmark decontamination: size-partitioned MinHash containment search of short items inside long documents.

Items fall into classes by their number of distinct shingles (powers of two). From the largest size of a class follows how
many of an item's smallest shingle hashes must be kept, so that a document with ``threshold`` of the item's shingles is
sure to hold one of them: at most ``u - ceil(threshold * u)`` may be missing of ``u``. This bottom sketch is searched
among all shingle hashes of every document; candidates are verified by exact containment of the shingle texts.

Words are runs of letters and digits, A-Z in lower case, so that punctuation between them doesn't matter. Items with fewer
words than a shingle are one shingle of their own length. Items without words are found nowhere. Null and empty documents
contain nothing; very long ones are searched whole. Documents with equal id and equal text count as one in the pairs;
null ids are matched as an id of their own. Repeated items (equal id and words) count as one; items that share an id but not
their words are told apart. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.scratch import stored
from gridseries.llm.text import TERM, free_name, let, lower_ascii, whole, words

LENGTH = 5
THRESHOLD = 0.8


def _runs(of: Column, length: int, make) -> Column:
    """``make`` of every run of ``length`` words; shorter texts have none."""
    return let(of, lambda w: F.when(F.size(w) < length, F.array()).otherwise(F.transform(
        F.sequence(F.lit(0), F.size(w) - length), lambda i: make([F.get(w, i + k) for k in range(length)]))))


def _joined(parts: list[Column]) -> Column:
    return F.concat_ws(" ", *parts)


def _terms(text: Column) -> Column:
    return words(lower_ascii(whole(text)), TERM)


def sketches(items: DataFrame, length: int = LENGTH, threshold: float = THRESHOLD) -> DataFrame:
    """Items with their distinct shingles (length, text) and the hashes that are searched for."""
    def of(w):
        found = F.when(F.size(w) == 0, F.array().cast("array<string>"))
        for n in range(1, length):
            found = found.when(F.size(w) == n, F.array(F.array_join(w, " ")))
        return F.array_distinct(found.otherwise(F.transform(
            F.sequence(F.lit(0), F.size(w) - length), lambda i: _joined([F.get(w, i + k) for k in range(length)]))))

    cut = items.select("item_id", let(_terms(F.col("text")), lambda w: F.struct(
        F.least(F.size(w), F.lit(length)).alias("length"), of(w).alias("shingles"))).alias("x")).select("item_id", "x.*")
    cut = cut.withColumns({"n": F.size("shingles"), "item_hash": F.xxhash64("shingles")}).filter("n > 0").dropDuplicates(
        ["item_id", "item_hash"])
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    keep = largest - F.ceil(largest * F.lit(threshold) - F.lit(1e-9)) + 1
    hashes = F.array_sort(F.transform("shingles", lambda s: F.xxhash64(s)))
    return cut.withColumn("sketch", F.slice(hashes, 1, keep.cast("int")))


def contaminated(docs: DataFrame, items: DataFrame, length: int = LENGTH, threshold: float = THRESHOLD,
                 text: str = "text") -> DataFrame:
    """(doc_id, text_hash, item_id, n_shingles, n_shared, containment) of all pairs at or above the threshold."""
    known = stored(sketches(items, length, threshold))
    lengths = sorted(r["length"] for r in known.select("length").distinct().collect())  # at most ``length`` values
    source = docs.select("doc_id", F.xxhash64(whole(F.col(f"`{text}`"))).alias("text_hash"),
                         F.col(f"`{text}`").alias("text"))
    # A shingle's text is hashed as one string on both sides.
    hashes = let(_terms(F.col("text")), lambda w: F.concat(F.array().cast("array<bigint>"), *[
        _runs(w, n, lambda parts: F.xxhash64(_joined(parts))) for n in lengths]))
    item = ["item_id", "item_hash"]
    searched = known.select(*item, F.explode("sketch").alias("hash"))
    candidates = stored(source.select("doc_id", "text_hash", F.explode(hashes).alias("hash")).join(searched, "hash").select(
        "doc_id", "text_hash", *item).distinct())
    hit = source.alias("d").join(candidates.select("doc_id", "text_hash").distinct().alias("c"), _same(
        "doc_id", "text_hash"), "left_semi")
    texts = let(_terms(F.col("text")), lambda w: F.array_distinct(F.concat(F.array().cast("array<string>"), *[
        _runs(w, n, _joined) for n in lengths])))
    parts = known.select(*item, F.col("n").cast("long").alias("n_shingles"), F.explode("shingles").alias("shingle"))
    shared = hit.select("doc_id", "text_hash", F.explode(texts).alias("shingle")).join(parts, "shingle").groupBy(
        "doc_id", "text_hash", *item, "n_shingles").agg(F.count_distinct("shingle").alias("n_shared"))
    verified = shared.alias("d").join(candidates.alias("c"), _same("doc_id", "text_hash", *item), "left_semi")
    return verified.select("doc_id", "text_hash", "item_id", "n_shingles", "n_shared", (
        F.col("n_shared") / F.col("n_shingles")).alias("containment")).filter(
        F.col("n_shared") >= F.col("n_shingles") * F.lit(threshold) - F.lit(1e-9))


def _same(*names: str) -> Column:
    """Equal columns of the frames d and c, nulls equal."""
    found = F.lit(True)
    for n in names:
        found = found & F.col(f"d.{n}").eqNullSafe(F.col(f"c.{n}"))
    return found


def decontaminate(docs: DataFrame, items: DataFrame, length: int = LENGTH, threshold: float = THRESHOLD,
                  text: str = "text") -> DataFrame:
    """The documents in which no item is found."""
    name, digest = (free_name(docs.columns, n) for n in ("bad_id", "bad_hash"))
    bad = stored(contaminated(docs, items, length, threshold, text).select("doc_id", "text_hash").distinct()).toDF(name, digest)
    key = F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64(whole(F.col(f"`{text}`"))) == F.col(digest))
    return docs.join(bad, key, "left_anti")
