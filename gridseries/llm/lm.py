"""LM scoring by prediction by partial matching over byte contexts, trained on one part of a corpus.

The trie of all contexts is a set of distributed tables, one per context length, and no task or driver holds it whole:

1. Documents fall into blocks of bounded size. Each block asks for the cost of the byte runs (context and next byte) that
   it holds, and reports how often its training documents hold them.
2. The runs of all blocks are added up; shorter contexts follow by dropping the oldest byte.
3. The cost of each run is found by walking from the longest context down: in a known context a symbol costs its count
   over total plus distinct symbols; an unseen one costs the escape (distinct over the same) and goes on one context
   shorter, where the symbols of the longer context are excluded. Below the empty context the symbols left are equally likely.
4. The costs go back to the blocks that asked, and each block adds up the code length of its documents.

Words are counted and sent back in the same way for the unigram base. A text is read as its words, A-Z in lower case, with
one space between them and an end symbol; the start counts as a context. ``score`` is log10 of the model's probability.

Null and empty texts have no words: their only token is the end. Very long texts are scored whole; one larger than a block
is a block of its own. Repeated rows are scored each, and counted each if they train. A null id counts as the empty id for
the fold. Without training texts all symbols are equally likely. An empty table gives an empty result. Other columns of
the input are left out. Words are identified by a 64-bit hash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.scratch import stored

ORDER = 4
BLOCK_BYTES = 32 << 20
CHUNK = 1 << 22
SYMBOLS = 257  # bytes, and the end of a text
WIDTH = 9  # bits of a symbol: byte + 1, or 0 for the start and the end
RUN, WORD = 0, 1
END_WORD = 0


def terms(text: str | None) -> list[bytes]:
    """The words of a text; ``bytes.lower`` and ``bytes.split`` know A-Z and ASCII spaces only."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def runs(line: bytes, order: int) -> np.ndarray:
    """The number of every context with its next symbol, in the order of a line of words, the end last."""
    symbols = np.frombuffer(line, np.uint8).astype(np.int64) + 1
    symbols = np.concatenate((np.zeros(order, np.int64), symbols, np.zeros(1, np.int64)))
    size, found = len(symbols) - order, np.zeros(len(symbols) - order, np.int64)
    for k in range(order + 1):
        found = (found << WIDTH) | symbols[k: k + size]
    return found


def word_key(word: bytes) -> int:
    import xxhash

    return (xxhash.xxh64_intdigest(word) | 1) - (1 << 63)


def in_blocks(docs: DataFrame, trains: Column, text: str = "text") -> DataFrame:
    """(doc_id, packed, trains, block): the words of each row, compressed, in blocks of the partition they are read in."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, room, press = TaskContext.get().partitionId() << 24, BLOCK_BYTES, zstandard.ZstdCompressor()
        for batch in batches:
            packed, numbers = [], []
            for t in batch.pop("text"):
                line = b" ".join(terms(t))
                if room < len(line):
                    block, room = block + 1, BLOCK_BYTES
                room -= len(line)
                packed.append(press.compress(line))
                numbers.append(block)
            yield batch.assign(packed=packed, block=np.array(numbers, np.int64))

    rows = docs.select(F.col("doc_id").cast("string"), trains.alias("trains"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id string, trains boolean, packed binary, block long")


class _Counts:
    """Counts of keys, added up chunk by chunk so that memory follows the distinct keys."""

    def __init__(self):
        self.fresh, self.held, self.done = [], 0, []

    def add(self, keys: np.ndarray) -> None:
        self.fresh.append(keys)
        self.held += len(keys)
        if self.held > CHUNK:
            self._fold()

    def _fold(self) -> None:
        if self.fresh:
            self.done.append(np.unique(np.concatenate(self.fresh), return_counts=True))
            self.fresh, self.held = [], 0

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self._fold()
        if not self.done:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        keys, places = np.unique(np.concatenate([k for k, _ in self.done]), return_inverse=True)
        return keys, np.bincount(places, np.concatenate([n for _, n in self.done])).astype(np.int64)


def asked(blocks: DataFrame, order: int) -> DataFrame:
    """(block, kind, key, n): runs and words of each block, and how often its training texts hold them.

    A key may come twice for a block.
    """
    def rows_of(block: int, train: _Counts, other: _Counts, words: Counter, ends: int) -> pd.DataFrame:
        keys, counts = train.result()
        extra = other.result()[0]
        names = np.fromiter((word_key(w) for w in words), np.int64, len(words))
        parts = [(RUN, keys, counts), (RUN, extra, np.zeros(len(extra), np.int64)),
                 (WORD, np.append(names, END_WORD), np.append(np.fromiter(words.values(), np.int64, len(words)), ends))]
        return pd.concat([pd.DataFrame({"block": block, "kind": np.int32(k), "key": x, "n": n}) for k, x, n in parts])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        now, train, other, words, ends = None, _Counts(), _Counts(), Counter(), 0
        for batch in batches:
            for packed, trains, block in zip(batch["packed"], batch["trains"], batch["block"], strict=True):
                if now is not None and block != now:
                    yield rows_of(now, train, other, words, ends)
                    train, other, words, ends = _Counts(), _Counts(), Counter(), 0
                now, line = block, unpack(packed)
                if trains:
                    train.add(runs(line, order))
                    words.update(line.split())
                    ends += 1
                else:
                    other.add(runs(line, order))
                    for w in line.split():
                        words.setdefault(w, 0)
        if now is not None:
            yield rows_of(now, train, other, words, ends)

    return blocks.select("packed", "trains", "block").mapInPandas(run, "block long, kind int, key long, n long")


def _keep(order: int) -> int:
    return (1 << WIDTH * (order + 1)) - 1


def run_costs(counts: DataFrame, order: int) -> DataFrame:
    """(key, cost): log10 of the probability of a run's last symbol, for every run of a stored table (key, n)."""
    def context(key: Column) -> Column:
        return F.shiftright(key, WIDTH)

    def with_context(level: DataFrame) -> DataFrame:
        of = level.groupBy(context(F.col("key")).alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
        return level.withColumn("context", context(F.col("key"))).join(of, "context")

    level = stored(with_context(counts.filter("n > 0").select("key", "n")))
    # Costs at the longest context: known symbols end here, the others escape if their context is known.
    heads = level.select("context", "total", "kinds").distinct()
    found = counts.select("key", F.col("key").alias("run"), context(F.col("key")).alias("context")).join(
        level.select("key", "n"), "key", "left").join(heads, "context", "left")
    state = stored(_step(found, F.col("total"), F.col("kinds")).select("run", "cost", "done", "known"))
    ended = [state.filter("done").select("run", "cost")]
    for o in range(order - 1, -1, -1):
        longer = level.select("key", F.col("context").alias("longer"))
        shorter = level.groupBy(F.col("key").bitwiseAND(F.lit(_keep(o))).alias("key")).agg(F.sum("n").alias("n"))
        level = stored(with_context(shorter))
        # What the symbols of each longer context take of the shorter one.
        taken = longer.withColumn("key", F.col("key").bitwiseAND(F.lit(_keep(o)))).join(
            level.select("key", "n"), "key").groupBy("longer").agg(
            F.sum("n").alias("taken"), F.count(F.lit(1)).alias("taken_kinds"))
        heads = level.select("context", "total", "kinds").distinct()
        open_runs = state.filter(~F.col("done")).withColumns({
            "key": F.col("run").bitwiseAND(F.lit(_keep(o))),
            "longer": context(F.col("run").bitwiseAND(F.lit(_keep(o + 1))))})
        open_runs = open_runs.withColumn("context", context(F.col("key")))
        found = open_runs.join(level.select("key", "n"), "key", "left").join(heads, "context", "left").join(
            taken, "longer", "left")
        total = F.col("total") - F.coalesce("taken", F.lit(0))
        kinds = F.col("kinds") - F.coalesce("taken_kinds", F.lit(0))
        state = stored(_step(found, total, kinds, F.col("cost")).select("run", "cost", "done", "known"))
        ended.append(state.filter("done").select("run", "cost"))
    # Below the empty context: the symbols never seen, all alike.
    left = max(SYMBOLS - level.count(), 1)
    last = state.filter(~F.col("done")).select("run", (F.col("cost") - math.log10(left)).alias("cost"))
    for part in ended:
        last = last.unionByName(part)
    return last.select(F.col("run").alias("key"), "cost")


def _step(found: DataFrame, total: Column, kinds: Column, before: Column | None = None) -> DataFrame:
    """Cost after one context: a null total is an unknown context; no kinds left is a sure escape."""
    before = F.lit(0.0) if before is None else before
    seen, known = F.col("n").isNotNull(), total.isNotNull() & (kinds > 0)
    cost = F.when(seen, before + F.log10(F.col("n") / (total + kinds))).when(
        known, before + F.log10(kinds / (total + kinds))).otherwise(before)
    return found.withColumns({"cost": cost, "done": seen, "known": known})


def word_costs(counts: DataFrame, tokens: int, kinds: int) -> DataFrame:
    """(key, cost, known) of a stored table (key, n) by the smoothed unigram."""
    cost = F.log10((F.col("n") + 0.5) / F.lit(tokens + 0.5 * (kinds + 1)))
    return counts.select("key", cost.alias("cost"), (F.col("n") > 0).alias("known"))


RESULT = ("doc_id string, trains boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
          "n_symbols long")


def score(docs: DataFrame, trains: Column, order: int = ORDER, text: str = "text") -> DataFrame:
    """Scores of all documents by the model and by the unigram base; ``trains`` marks the rows that teach both.

    ``order`` is the longest context in bytes, at most 6.
    """
    if not 0 <= order <= 6:
        raise ValueError("contexts of 0 to 6 bytes are possible")
    blocks = stored(in_blocks(docs, trains, text))
    requests = stored(asked(blocks, order))
    counts = stored(requests.groupBy("kind", "key").agg(F.sum("n").alias("n")))
    word_counts = counts.filter(F.col("kind") == WORD).select("key", "n")
    sums = word_counts.agg(F.sum("n").alias("tokens"), F.count(F.when(F.col("n") > 0, 1)).alias("kinds")).first()
    tokens = int(sums["tokens"] or 0)
    run_table = run_costs(counts.filter(F.col("kind") == RUN).select("key", "n"), order).select(
        F.lit(RUN).alias("kind"), "key", "cost", F.lit(True).alias("known"))
    word_table = word_costs(word_counts, tokens, sums["kinds"]).select(F.lit(WORD).alias("kind"), "key", "cost", "known")
    costs = stored(run_table.unionByName(word_table))
    answers = requests.select("block", "kind", "key").join(costs, ["kind", "key"])

    def add_up(key: tuple, texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        is_run = (table["kind"] == RUN).to_numpy()
        of_run, of_word = table[is_run], table[~is_run]
        keys, first = np.unique(of_run["key"].to_numpy(), return_index=True)
        values = of_run["cost"].to_numpy()[first]
        by_key = dict(zip(of_word["key"].tolist(), zip(of_word["cost"].tolist(), of_word["known"].tolist(), strict=True),
                          strict=True))
        unpack = zstandard.ZstdDecompressor().decompress
        memo: dict[bytes, tuple[float, bool]] = {}
        out = []
        for doc_id, learns, packed in zip(texts["doc_id"], texts["trains"], texts["packed"], strict=True):
            line = unpack(packed)
            words = line.split()
            for w in set(words):
                if w not in memo:
                    memo[w] = by_key[word_key(w)]
            each = [memo[w] for w in words]
            each.append(by_key[END_WORD])
            numbers = runs(line, order)
            cost = values[np.searchsorted(keys, numbers)]
            out.append((doc_id, learns, len(each), sum(k for _, k in each), tokens, math.fsum(c for c, _ in each),
                        float(cost.sum()), len(numbers)))
        return pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])

    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(add_up, RESULT)
    return scored.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
