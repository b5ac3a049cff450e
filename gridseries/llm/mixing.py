"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

1. Words are counted per source; weights become targets in words, none above ``max_repeats`` times its source.
2. A source's documents fall into blocks by a hash of all their columns and, among rows alike in all of them, their number. The mix takes whole passes over a source, then whole blocks in a
   permuted order, then documents of one last block, so that the words taken come within one document of the target.
3. The exact block quotas of all sources are split between output shards by a binary tree: each node draws the quotas
   of its left half from a multivariate hypergeometric distribution seeded by the node, so any task can compute the
   quotas of any shard, and a rerun gives the same ones. The quotas of all shards add up to the source's quota.
4. Shards take disjoint ranges of each source's permuted blocks, and order their rows by a hash of their own.

Only the table of sources (one row per source name) reaches the driver; more than ``MAX_SOURCES`` names raise an error.

Null and empty texts have no words; they follow their block and take none. The null source is a source of its own, the last.
Repeated rows are documents of their own: they are numbered, so that they spread over blocks like others. Null and shared ids
are documents like others; no id decides alone. Sources without words get the target 0. An empty table gives an empty mix. Very long texts are taken whole or not at all.
Columns of the input that bear the name of a result column are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from gridseries.llm.scratch import stored
from gridseries.llm.text import words

MAX_SOURCES = 100_000
BLOCK_WORDS = 1 << 16
BLOCK_DOCS = 1 << 10
RUN_BLOCKS = 256
SHARD_BLOCKS = 64
SEED = 11
RESULT = {"size", "source_size", "target", "taken", "placed"}
REPEATS = 1 << 12


@dataclass(frozen=True)
class Source:
    name: str | None
    size: int
    docs: int
    weight: float
    target: float
    blocks: int

    @property
    def passes(self) -> int:
        return int(self.target // self.size) if self.size else 0

    @property
    def rest(self) -> float:
        """Words still due after the whole passes."""
        return self.target - self.passes * self.size


def cycled_weights(names: list[str | None]) -> list[float]:
    """1, 2, 3 and again, over sources by code point, null last."""
    return [float(1 + i % 3) for i in range(len(names))]


def targets(sizes: list[int], weights: list[float], max_repeats: float = 3.0) -> list[float]:
    """Shares of the total by weight; what lies above a source's limit goes to the others by weight."""
    found = [0.0] * len(sizes)
    is_open, left = [i for i, s in enumerate(sizes) if s and weights[i] > 0], float(sum(sizes))
    while is_open:
        unit = left / sum(weights[i] for i in is_open)
        full = [i for i in is_open if weights[i] * unit > max_repeats * sizes[i]]
        if not full:
            for i in is_open:
                found[i] = weights[i] * unit
            break
        for i in full:
            found[i] = float(max_repeats * sizes[i])
            left -= found[i]
        is_open = [i for i in is_open if i not in set(full)]
    return found


def survey(sized: DataFrame, max_repeats: float, weights=cycled_weights) -> list[Source]:
    """The sources with their targets, by code point, null last."""
    rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("docs")).limit(
        MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    names = [r["source"] for r in rows]
    share = weights(names)
    due = targets([r["size"] for r in rows], share, max_repeats)
    return [Source(r["source"], r["size"], r["docs"], w, t,
                   max(math.ceil(r["size"] / BLOCK_WORDS), math.ceil(r["docs"] / BLOCK_DOCS)))
            for r, w, t in zip(rows, share, due, strict=True)]


def _number(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("|".join(map(str, parts)).encode(), digest_size=8).digest(), "big")


def permutation(source: int, blocks: int, turn: int, seed: int) -> tuple[int, int]:
    """Factor and offset of a permutation of a source's blocks; another one for each pass."""
    factor = 1 + _number(seed, source, turn, "factor") % max(blocks, 1)
    while math.gcd(factor, blocks) != 1:
        factor += 1
    return factor, _number(seed, source, turn, "offset") % max(blocks, 1)


def split(quotas: tuple[int, ...], left: int, seed: tuple) -> tuple[int, ...]:
    """Draw ``left`` of the blocks without putting back: how many of them come from each source."""
    rng = np.random.default_rng(_number(*seed))
    out, rest, due = [], sum(quotas), left
    for q in quotas:
        rest -= q
        taken = int(rng.hypergeometric(q, rest, due)) if q and due and rest else min(q, due)
        out.append(taken)
        due -= taken
    return tuple(out)


def shard_quotas(total: tuple[int, ...], shards: int, seed: int):
    """A function shard -> (blocks of each source in earlier shards, blocks in this one), by a walk down the tree."""
    @lru_cache(maxsize=4096)
    def halves(low: int, high: int, quotas: tuple[int, ...]):
        middle = (low + high) // 2
        left = split(quotas, sum(quotas) * (middle - low) // (high - low), (seed, low, high))
        return middle, left, tuple(q - x for q, x in zip(quotas, left, strict=True))

    def leaf(shard: int):
        low, high, quotas, before = 0, shards, total, tuple(0 for _ in total)
        while high - low > 1:
            middle, left, right = halves(low, high, quotas)
            if shard < middle:
                high, quotas = middle, left
            else:
                low, quotas, before = middle, right, tuple(b + x for b, x in zip(before, left, strict=True))
        return before, quotas

    return leaf


def _source_table(spark: SparkSession, sources: list[Source], seed: int) -> DataFrame:
    """One row per source: its number, target, passes, and the permutation of its pass in parts."""
    rows = []
    for i, s in enumerate(sources):
        factor, offset = permutation(i, s.blocks, s.passes, seed)
        rows.append((s.name, i, s.size, s.target, s.blocks, s.passes, s.rest, factor, offset))
    return spark.createDataFrame(
        rows, "source string, source_no int, source_size long, target double, blocks long, passes int, rest double, "
        "factor long, shift long")


def _cut(ledger: DataFrame) -> DataFrame:
    """Per source the place of the block in which its words in part end, and the words due from that block.

    Blocks are added up in runs first, so no task sees all blocks of a source.
    """
    runs = ledger.groupBy("source_no", "rest", F.floor(F.col("place") / RUN_BLOCKS).alias("run")).agg(
        F.sum("words").alias("words"))
    by_run = Window.partitionBy("source_no").orderBy("run")
    runs = runs.withColumn("before", F.sum("words").over(by_run) - F.col("words")).filter(
        (F.col("before") < F.col("rest")) & (F.col("before") + F.col("words") >= F.col("rest")))
    inside = ledger.join(F.broadcast(runs.select("source_no", "run", "before")), [
        "source_no"]).filter(F.floor(F.col("place") / RUN_BLOCKS) == F.col("run"))
    by_place = Window.partitionBy("source_no").orderBy("place")
    sums = inside.withColumn("start", F.col("before") + F.sum("words").over(by_place) - F.col("words"))
    return sums.filter((F.col("start") < F.col("rest")) & (F.col("start") + F.col("words") >= F.col("rest"))).select(
        "source_no", F.col("place").alias("cut_place"), F.col("block").alias("cut_block"),
        (F.col("rest") - F.col("start")).alias("due"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def _identity(docs: DataFrame, seed: int) -> list[Column]:
    """Two 64-bit hashes of a whole row. What Spark can't hash (maps, variants) counts by its JSON form."""
    def hashable(kind: T.DataType) -> bool:
        if isinstance(kind, T.ArrayType):
            return hashable(kind.elementType)
        if isinstance(kind, T.StructType):
            return all(hashable(f.dataType) for f in kind)
        return not isinstance(kind, (T.MapType, T.VariantType))

    columns = [F.col(f"`{f.name}`") if hashable(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`")))
               for f in docs.schema]
    # A null leaves Spark's hash as it is, so nulls are marked beside the values.
    marks = [c.isNull() for c in columns]
    return [F.xxhash64(F.lit(seed + k), *columns, *marks) for k in (0, 1)]


def _numbered(rows: DataFrame, repeated: DataFrame | None) -> DataFrame:
    """Rows with their ``number`` among rows that are alike in all columns.

    Such rows are one row and a count, so they are numbered by making that many again, ``REPEATS`` in a task.
    """
    if repeated is None:
        return rows.withColumn("number", F.lit(0).cast("long"))
    flagged = rows.join(repeated, ["h1", "h2"], "left")
    alone = flagged.filter("times is null").drop("times").withColumn("number", F.lit(0).cast("long"))
    each = [F.first(c).alias(c) for c in rows.columns if c not in ("h1", "h2")]
    many = flagged.filter("times is not null").groupBy("h1", "h2", "times").agg(*each).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / REPEATS))))
    last = F.least((F.col("chunk") + 1) * REPEATS, F.col("times")) - 1
    many = many.repartition(F.xxhash64("h1", "h2", "chunk")).withColumn(
        "number", F.explode(F.sequence(F.col("chunk") * REPEATS, last))).drop("chunk", "times")
    return alone.unionByName(many)


def mix(docs: DataFrame, size: Column | None = None, max_repeats: float = 3.0, weights=cycled_weights,
        seed: int = SEED, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """The input with size, source_size, target, taken and ``placed``: the (shard, order) of each copy taken.

    ``size`` is an expression over the input, by default the words of its text.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT]
    h1, h2 = _identity(docs, seed)
    # The input's columns travel as one, so that their names clash with none made here.
    counted = docs.select(F.struct(*kept).alias("row"), F.col("source").cast("string").alias("source"),
                          (word_count(F.col("text")) if size is None else size).alias("size"), h1.alias("h1"), h2.alias("h2"))
    slim = stored(counted.drop("row"))
    sources = survey(slim, max_repeats, weights)
    repeated = stored(slim.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times")).filter("times > 1"))
    repeated = repeated if repeated.limit(1).count() else None
    return _placed(_numbered(counted, repeated), _plan(_numbered(slim, repeated), sources, seed, shard_blocks), sources, seed)


def _keyed(rows: DataFrame, sources: list[Source], seed: int) -> DataFrame:
    """Rows with their source's columns and their block. Sources are at most MAX_SOURCES rows."""
    table = _source_table(rows.sparkSession, sources, seed)
    joined = rows.join(F.broadcast(table.withColumnRenamed("source", "_source")),
                       F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    return joined.withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "h1", "h2", "number"), F.col("blocks")))


def _rank(seed: int) -> Column:
    return F.xxhash64(F.lit(seed + 1), "h1", "h2", "number")


def _plan(slim: DataFrame, sources: list[Source], seed: int, shard_blocks: int) -> DataFrame:
    """One row per block that the mix touches: the shards of its copies.

    Of a block whose last copy is taken in part, ``ranks`` are the hash ranks of the documents in that copy.
    """
    spark = slim.sparkSession
    keyed = _keyed(slim, sources, seed)
    ledger = stored(keyed.groupBy("source_no", "block", "rest", "blocks", "passes", "factor", "shift").agg(
        F.sum("size").alias("words")).withColumn(
        "place", F.pmod(F.col("block") * F.col("factor") + F.col("shift"), F.col("blocks"))))
    cuts = stored(_cut(ledger.filter("rest > 0")))
    cut_places = {r["source_no"]: r["cut_place"] for r in cuts.collect()}  # one row per source at most
    quotas = tuple(s.passes * s.blocks + (cut_places[i] + 1 if i in cut_places else 0) for i, s in enumerate(sources))
    shards = max(1, math.ceil(sum(quotas) / shard_blocks))
    turns = [[permutation(i, s.blocks, t, seed) for t in range(s.passes + 1)] for i, s in enumerate(sources)]
    blocks = [s.blocks for s in sources]

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaf = shard_quotas(quotas, shards, seed)
        inverse: dict[tuple[int, int], int] = {}
        for batch in batches:
            for shard in batch["id"]:
                out = []
                for no, (first, count) in enumerate(zip(*leaf(int(shard)), strict=True)):
                    for at in range(first, first + count):
                        turn, place = divmod(at, blocks[no])
                        factor, shift = turns[no][turn]
                        if (no, turn) not in inverse:
                            inverse[no, turn] = pow(factor, -1, blocks[no]) if blocks[no] > 1 else 0
                        out.append((no, (place - shift) * inverse[no, turn] % blocks[no], turn, int(shard)))
                yield pd.DataFrame(out, columns=["source_no", "block", "turn", "shard"])

    drawn = spark.range(shards).mapInPandas(draw, "source_no int, block long, turn int, shard int")
    copies = drawn.groupBy("source_no", "block").agg(
        F.sort_array(F.collect_list(F.struct("turn", "shard"))).alias("copies"))
    # Of the blocks cut in part (one a source) the last copy takes what still fits, in the order of a hash.
    cut = cuts.select("source_no", F.col("cut_block").alias("block"), "due")
    inside = keyed.join(F.broadcast(cut), ["source_no", "block"]).groupBy(
        "source_no", "block", "due", _rank(seed).alias("rank")).agg(F.sum("size").alias("size")).groupBy(
        "source_no", "block", "due").agg(F.sort_array(F.collect_list(F.struct("rank", "size"))).alias("docs"))

    def take(state, doc):
        fits = doc["size"] <= state["left"]
        return F.struct((state["left"] - F.when(fits, doc["size"]).otherwise(F.lit(0))).alias("left"), F.when(
            fits, F.concat(state["ranks"], F.array(doc["rank"]))).otherwise(state["ranks"]).alias("ranks"))

    none_yet = F.struct(F.col("due").alias("left"), F.array().cast("array<bigint>").alias("ranks"))
    ranks = inside.select("source_no", "block", F.aggregate("docs", none_yet, take, lambda x: x["ranks"]).alias("ranks"))
    return stored(copies.join(F.broadcast(ranks), ["source_no", "block"], "left"))


def _placed(counted: DataFrame, plan: DataFrame, sources: list[Source], seed: int) -> DataFrame:
    """Documents with the copies that the mix takes of them."""
    flagged = _keyed(counted, sources, seed).join(plan, ["source_no", "block"], "left")
    copies = F.coalesce(F.col("copies"), F.array().cast("array<struct<turn:int,shard:int>>"))
    beyond = F.col("ranks").isNotNull() & ~F.array_contains("ranks", _rank(seed))
    copies = F.when(beyond, F.filter(copies, lambda c: c["turn"] < F.col("passes"))).otherwise(copies)
    placed = F.transform(copies, lambda c: F.struct(
        c["shard"].alias("shard"), F.xxhash64(F.lit(seed), c["shard"], c["turn"], "h1", "h2", "number").alias("order")))
    return flagged.withColumn("placed", placed).select(
        "row.*", "size", "source_size", "target", (F.col("size") * F.size("placed")).alias("taken"), "placed")


def shards(mixed: DataFrame) -> DataFrame:
    """One row per copy taken, each shard in its own partition and in the shard's order."""
    kept = [c for c in mixed.columns if c.lower() not in ("placed", "shard", "order")]
    rows = mixed.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.explode("placed").alias("at"))
    return rows.select("row.*", "at.shard", "at.order").repartition("shard").sortWithinPartitions("shard", "order")
