"""A Merkle manifest of a dataset, with proofs by octopus multiproof.

Each row is a leaf: the SHA-256 of its fields with their lengths. Leaves of one group stand in order and every ``FANOUT``
consecutive nodes become their hash until one is left, the group's subroot; the subroots in order of group likewise
give the root. Digests are hashed as lower-case hex text, and a last run of fewer nodes, even of one, is hashed too.

1. Leaves are range-partitioned and sorted by group, id and digest, and stored with their numbers. ``LEAVES`` consecutive ones
   are a leaf partition: a piece of work of fixed size, whatever the skew. Counts of (partition, group) give each leaf's place.
2. Each partition reduces its leaves to the nodes whose parent is not whole inside it: at most 2 * (FANOUT - 1) a level.
   The tree above grows level by level from those alone.
3. Octopus: for its whole range of leaves a partition needs, at each level, only the siblings beside its two ends. It
   asks for the union of those coordinates that it can't derive, gets them by one join, derives what lies between
   itself, and expands every leaf's proof from that.

The same three steps run once over the leaves and once over the subroots, so there may be any number of groups.

Null fields are ``-``, and null groups and ids are values of their own, before all others. Empty and very long texts are hashed whole. Equal ids
stand in order of their leaves, and repeated rows are leaves of their own. An empty table gives an empty result. The columns of
the input that the caller names go along; those named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from gridseries.llm.scratch import stored

FANOUT = 8
LEAVES = 1 << 13
RANGE_ROWS = 1 << 14
RANGES = 1 << 12
LARGE_RANGE_ROWS = 1 << 22
HEX = 64
NODE = "grp string, total long, level int, place long, digest string"
PROOF = "proof string, path array<struct<place:int,width:int>>"
RESULT = {"leaf", "subroot", "root", "proof", "path"}


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """A value with the number of its bytes, so that no two lists of fields read alike; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*fields: Column) -> Column:
    """The digest of a row's fields."""
    return F.sha2(F.concat(*[field(f) for f in fields]), 256)


def levels_above(leaves: int) -> int:
    n, out = leaves, 0
    while n > 1:
        n, out = -(-n // FANOUT), out + 1
    return out


# Step 1: places


def _in_order(leaves: DataFrame) -> DataFrame:
    """Leaves (grp, key, digest, ...) stored in order, with their ``part`` and their ``number`` in the table."""
    ordered = ["grp", "key", "digest", "salt"]
    salted = stored(leaves.withColumn("salt", F.monotonically_increasing_id()))  # equal rows can be cut between ranges
    rows = salted.count()
    ranges = max(1, min(rows // RANGE_ROWS, RANGES), rows // LARGE_RANGE_ROWS)
    placed = salted.repartitionByRange(ranges, *ordered).sortWithinPartitions(*ordered).withColumn(
        "number", F.monotonically_increasing_id())
    return stored(placed.drop("salt", "key").withColumn("part", F.floor(F.col("number") / LEAVES).cast("long")))


def _spans(leaves: DataFrame) -> DataFrame:
    """(part, grp, first, count, start, total): each partition's range of places in each of its groups."""
    counts = leaves.groupBy("part", "grp").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("count"))
    group = Window.partitionBy("grp")
    return stored(counts.withColumns({
        "start": F.sum("count").over(group.orderBy("part")) - F.col("count"), "total": F.sum("count").over(group)}))


# Step 2: the nodes that partitions can't finish, and the tree above them


def _parents(digests: list[str], start: int, total: int) -> tuple[int, list[str]]:
    """The place of the first parent whose children are all among ``digests``, and the parents from there on."""
    first, end = -(-start // FANOUT), start + len(digests)
    last = -(-end // FANOUT) if end == total else end // FANOUT
    return first, [_sha("".join(digests[p * FANOUT - start: (p + 1) * FANOUT - start])) for p in range(first, last)]


def _cover(digests: list[str], start: int, total: int) -> list[tuple[int, int, str]]:
    """(level, place, digest) of the nodes over a range of leaves whose parent is not whole inside it."""
    out, level = [], 0
    while digests:
        first, parents = _parents(digests, start, total) if total > 1 else (0, [])
        inside = range(first * FANOUT, (first + len(parents)) * FANOUT)
        out += [(level, start + i, d) for i, d in enumerate(digests) if start + i not in inside]
        digests, start, total, level = parents, first, -(-total // FANOUT), level + 1
    return out


def _covers(leaves: DataFrame, spans: DataFrame) -> DataFrame:
    def reduce(key, own: pa.Table, ranges: pa.Table) -> pa.Table:
        digests, at, out = own.sort_by("number")["digest"].to_pylist(), 0, []
        for r in ranges.sort_by("first").to_pylist():
            out += [(r["grp"], r["total"], *node)
                    for node in _cover(digests[at: at + r["count"]], r["start"], r["total"])]
            at += r["count"]
        return _table(out, NODE)

    slim = leaves.select("part", "number", "digest")
    return stored(slim.groupBy("part").cogroup(spans.groupBy("part")).applyInArrow(reduce, NODE))


def _table(rows: list[tuple], schema: str) -> pa.Table:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
                                [n for n, _ in fields])


def _tree(covers: DataFrame) -> DataFrame:
    """The covers and all nodes above them. A run of children that meets here is complete: it lies in no one partition."""
    most = covers.agg(F.max("total")).first()[0] or 0
    nodes, current = covers, covers.filter("level = 0")
    for level in range(levels_above(most)):
        made = stored(current.filter(F.col("total") > FANOUT**level).groupBy(
            "grp", "total", F.floor(F.col("place") / FANOUT).cast("long").alias("place")).agg(
            F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("run")).select(
            "grp", "total", F.lit(level + 1).alias("level"), "place",
            F.sha2(F.array_join(F.transform("run", lambda n: n["digest"]), ""), 256).alias("digest")))
        nodes = nodes.unionByName(made)
        current = covers.filter(F.col("level") == level + 1).unionByName(made)
    return nodes


# Step 3: octopus


def missing(start: int, count: int, total: int) -> list[tuple[int, int]]:
    """(level, place) of the nodes that the proofs of a range of leaves need and that can't be derived from the range."""
    out, level, a, b, n = [], 0, start, start + count, total
    while n > 1:
        low, high = a // FANOUT * FANOUT, min(-(-b // FANOUT) * FANOUT, n)
        out += [(level, p) for p in [*range(low, a), *range(b, high)]]
        a, b, n, level = a // FANOUT, -(-b // FANOUT), -(-n // FANOUT), level + 1
    return out


def expand(digests: list[str], start: int, total: int, fetched: dict[tuple[int, int], str]) -> list[tuple[str, list]]:
    """Of each leaf of a range: its siblings, joined from the leaves to the top, and its path of (place, width) in its runs."""
    count, levels, begin, n = len(digests), [], start, total
    while n > 1:
        end = begin + len(digests)
        low, high = begin // FANOUT * FANOUT, min(-(-end // FANOUT) * FANOUT, n)
        row = [fetched[len(levels), p] for p in range(low, begin)] + digests + [
            fetched[len(levels), p] for p in range(end, high)]
        levels.append((low, row))
        digests = [_sha("".join(row[i: i + FANOUT])) for i in range(0, len(row), FANOUT)]
        begin, n = low // FANOUT, -(-n // FANOUT)
    shared: dict[tuple[int, int], tuple[str, list]] = {}

    def above(level: int, place: int) -> tuple[str, list]:
        if level == len(levels):
            return "", []
        if (level, place) not in shared:
            low, row = levels[level]
            first = place // FANOUT * FANOUT - low
            run, own = row[first: first + FANOUT], place % FANOUT
            joined, path = above(level + 1, place // FANOUT)
            shared[level, place] = "".join(run[:own] + run[own + 1:]) + joined, [(own, len(run)), *path]
        return shared[level, place]

    return [above(0, start + i) for i in range(count)]


def _asked(spans: DataFrame) -> DataFrame:
    schema = "part long, grp string, level int, place long"

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(r.part, r.grp, *node) for r in batch.itertuples() for node in missing(r.start, r.count_, r.total)]
            yield pd.DataFrame(rows, columns=["part", "grp", "level", "place"])

    return spans.withColumnRenamed("count", "count_").mapInPandas(ask, schema)


def _proofs(leaves: DataFrame, spans: DataFrame, nodes: DataFrame) -> DataFrame:
    """Leaves with ``proof`` and ``path`` up to their group's top."""
    got = _asked(spans).join(nodes, ["grp", "level", "place"]).groupBy("part", "grp").agg(
        F.collect_list(F.struct("level", "place", "digest")).alias("fetched"))  # at most 2 * (FANOUT - 1) a level
    ranges = spans.join(got, ["part", "grp"], "left")

    def prove(key, own: pa.Table, ranges: pa.Table) -> pa.Table:
        own = own.sort_by("number")
        digests, at, out = own["digest"].to_pylist(), 0, []
        for r in ranges.sort_by("first").to_pylist():
            fetched = {(n["level"], n["place"]): n["digest"] for n in r["fetched"] or []}
            out += expand(digests[at: at + r["count"]], r["start"], r["total"], fetched)
            at += r["count"]
        path = pa.list_(pa.struct([("place", pa.int32()), ("width", pa.int32())]))
        steps = [[{"place": p, "width": w} for p, w in way] for _, way in out]
        return own.drop_columns(["part", "number"]).append_column("proof", pa.array([p for p, _ in out], pa.string())) \
            .append_column("path", pa.array(steps, path))

    schema = StructType([f for f in leaves.schema if f.name not in ("part", "number")] + StructType.fromDDL(PROOF).fields)
    return leaves.groupBy("part").cogroup(ranges.groupBy("part")).applyInArrow(prove, schema)


def _grown(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves with proofs, and (grp, top)."""
    ordered = _in_order(leaves)
    spans = _spans(ordered)
    nodes = _tree(_covers(ordered, spans))
    return _proofs(ordered, spans, nodes), nodes.groupBy("grp").agg(F.max_by("digest", "level").alias("top"))


def manifest(docs: DataFrame, fields: list[str], group: str = "lang", order: str = "doc_id",
             carry: list[str] | None = None) -> DataFrame:
    """One row per row: the columns ``carry`` (by default group and order), leaf, subroot, root, proof and path.

    ``proof`` holds the siblings from the leaf to the root as hex digits, ``path`` the place among its run and the run's
    width for each level. ``fold`` leads back to the root.
    """
    kept = [c for c in (carry if carry is not None else [group, order]) if c.lower() not in RESULT]
    # The input's columns travel as one, so that their names clash with none made here.
    row = F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(None).cast("int").alias("none"))
    name = F.col(f"`{group}`").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("grp"), F.col(f"`{order}`").alias("key"), row.alias("row"),
        leaf(*[F.col(f"`{c}`") for c in fields]).alias("digest"))
    proven, tops = _grown(leaves)
    tops = stored(tops)
    upper, root = _grown(tops.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("grp").alias("of"),
                                     F.col("top").alias("digest")))
    upper = upper.select(F.col("of").alias("grp"), F.col("digest").alias("subroot"), F.col("proof").alias("upper_proof"),
                         F.col("path").alias("upper_path"))
    top = root.first()
    return proven.join(stored(upper), "grp").select(
        *[F.col("row")[c].alias(c) for c in kept], F.col("digest").alias("leaf"), "subroot",
        F.lit(top["top"] if top else None).cast("string").alias("root"),
        F.concat("proof", "upper_proof").alias("proof"), F.concat("path", "upper_path").alias("path"))


def fold(digest: Column, proof: Column, path: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    def up(state: Column, step: Column) -> Column:
        before, after = step["place"] * HEX, (step["width"] - 1 - step["place"]) * HEX
        run = F.concat(F.substr(proof, state["at"] + 1, before), state["digest"],
                       F.substr(proof, state["at"] + 1 + before, after))
        return F.struct(F.sha2(run, 256).alias("digest"), (state["at"] + before + after).alias("at"))

    return F.aggregate(path, F.struct(digest.alias("digest"), F.lit(0).alias("at")), up, lambda s: s["digest"])
