"""SentencePiece BPE encoding and decoding in vectorised merge rounds.

The merges of a model are a table (left symbol, right symbol) -> (rank, merged symbol), built once on the driver from the
model file and broadcast (its size is that of the vocabulary). A task cuts texts into words that no merge can cross: between two
characters that stand side by side in no piece. Distinct words lie side by side in flat numpy arrays. A round finds the least
pair rank of every word (a segmented minimum), merges all its pairs of that rank at once, the leftmost of overlapping ones
first, and compacts the arrays; words without a pair left retire. A merge whose new pair would come before the word's next
one ends the word's round, so the order is that of the library also where ranks tie or a longer piece has a better rank.
Words that need more than ``FULL_ROUNDS`` go on with their minima kept in a heap instead of being searched anew each round.

Null and empty texts have no pieces: only the begin and end ids, and they decode to the empty text. Very long texts are encoded whole, cut
only where no merge can cross. Repeated rows and null ids are rows like others, and an empty table gives an empty result.
Columns of the input go along; those named like a result column are replaced. Characters without a piece become byte pieces.
Ids outside the vocabulary are an error, null ids of a text decode to the empty text.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridseries.llm.text import free_name, whole

SPACE = "▁"
CODE_POINTS = 0x110000
NEVER = np.int32(2**31 - 1)
FULL_ROUNDS = 48
GROUP_CHARS = 1 << 19
MEMO_WORDS = 1 << 17
MEMO_CHARS = 64
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    """One replacement character for each byte that is no part of a character."""
    return "�" * (error.end - error.start), error.end


@dataclass(frozen=True)
class Vocabulary:
    """A BPE model as arrays. A character without a piece is the symbol ``size`` + its code point."""

    size: int
    begin: int
    end: int
    dummy_prefix: bool
    words_start_by_space: bool
    chars: np.ndarray  # code points that are pieces
    char_ids: np.ndarray
    beside: np.ndarray  # pairs of code points that some piece has side by side, sorted
    pairs: np.ndarray  # (left, right) of every merge as one number, sorted
    ranks: np.ndarray
    merged: np.ndarray
    byte_ids: np.ndarray
    spaced: np.ndarray  # pieces that begin with a space
    surface: bytes
    surface_start: np.ndarray

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        return np.where(self.chars[at] == points, self.char_ids[at], points + self.size)

    def cut(self, points: np.ndarray) -> np.ndarray:
        """Whether no merge can cross from each point to the next one."""
        keys = points[:-1] * CODE_POINTS + points[1:]
        return self.beside[np.minimum(np.searchsorted(self.beside, keys), len(self.beside) - 1)] != keys

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged symbol of pairs; what never merges has the rank NEVER."""
        keys = left * (self.size + CODE_POINTS) + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], NEVER), self.merged[at]


def load(path: str) -> Vocabulary:
    """The tables of a SentencePiece BPE model with byte pieces and without a character map, read on the driver."""
    from sentencepiece import sentencepiece_model_pb2

    with open(path, "rb") as file:
        model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    rules, kinds = model.normalizer_spec, {p.type for p in model.pieces}
    if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path} is no BPE model of normal and byte pieces")
    if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
        raise ValueError(f"{path} changes characters before encoding")
    if model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"{path} ends words with spaces")
    size, normal = len(model.pieces), {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
    scores = sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True)
    rank_of = {s: i for i, s in enumerate(scores)}

    def symbol(part: str) -> int | None:
        return normal.get(part, size + ord(part) if len(part) == 1 else None)

    pairs, beside = {}, set()
    for piece, i in normal.items():
        beside.update(ord(a) * CODE_POINTS + ord(b) for a, b in zip(piece, piece[1:], strict=False))
        for at in range(1, len(piece)):
            left, right = symbol(piece[:at]), symbol(piece[at:])
            if left is not None and right is not None:
                pairs[left * (size + CODE_POINTS) + right] = (rank_of[model.pieces[i].score], i)
    keys = sorted(pairs) or [-1]
    singles = sorted((ord(p), i) for p, i in normal.items() if len(p) == 1) or [(-1, -1)]
    bytes_of, byte_ids = [], np.zeros(256, np.int64)
    for i, p in enumerate(model.pieces):
        if p.type == BYTE:
            byte_ids[int(p.piece[3:5], 16)] = i
        bytes_of.append({NORMAL: p.piece.replace(SPACE, " ").encode(), CONTROL: b"",
                         UNKNOWN: model.trainer_spec.unk_surface.encode()}.get(p.type) if p.type != BYTE
                        else bytes([int(p.piece[3:5], 16)]))
    return Vocabulary(
        size, model.trainer_spec.bos_id, model.trainer_spec.eos_id, rules.add_dummy_prefix,
        not any(SPACE in p.lstrip(SPACE) for p in normal),
        np.array([c for c, _ in singles]), np.array([i for _, i in singles]), np.array(sorted(beside) or [-1]),
        np.array(keys), np.array([pairs.get(k, (NEVER, 0))[0] for k in keys], np.int32),
        np.array([pairs.get(k, (NEVER, 0))[1] for k in keys]), byte_ids,
        np.array([p.type == NORMAL and p.piece.startswith(SPACE) for p in model.pieces]), b"".join(bytes_of),
        np.cumsum([0, *map(len, bytes_of)]))


# Encoding


def _runs_of(word: np.ndarray) -> np.ndarray:
    """Where each word starts in an array of word numbers."""
    return np.concatenate(([0], np.flatnonzero(word[1:] != word[:-1]) + 1))


def _pairs_at(vocab: Vocabulary, sym: np.ndarray, word: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and merged symbol of the pairs that start at some places; a word's last symbol has none."""
    after = np.minimum(at + 1, len(sym) - 1)
    rank, into = vocab.pair(sym[at], sym[after])
    return np.where((after > at) & (word[after] == word[at]), rank, NEVER), into


def _chosen(vocab: Vocabulary, sym: np.ndarray, word: np.ndarray, rank: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Places of the pairs that one round merges."""
    starts = _runs_of(word)
    sizes = np.diff(np.append(starts, len(word)))
    least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
    wanted = (rank == least) & (rank < NEVER)
    # Of overlapping pairs the leftmost ones: every second place of a run of wanted places.
    places = np.arange(len(sym))
    first = wanted & ~np.concatenate(([False], wanted[:-1]))
    at = np.flatnonzero(wanted & ((places - np.maximum.accumulate(np.where(first, places, 0))) % 2 == 0))
    taken = np.zeros(len(sym) + 3, bool)
    taken[at] = True
    new, own, last = into[at], word[at], len(sym) - 1
    before = np.where((at >= 2) & taken[at - 2], into[at - 2], sym[at - 1])
    left = np.where((at >= 1) & (word[at - 1] == own), vocab.pair(before, new)[0], NEVER)
    after = np.minimum(at + 2, last)
    right = np.where((at + 2 <= last) & (word[after] == own), vocab.pair(new, sym[after])[0], NEVER)
    stops = np.minimum(left, right) <= rank[at]
    if stops.any():  # the new pair comes before the word's next one: the word's round ends here
        number = np.repeat(np.arange(len(starts)), sizes)[at]
        end = np.full(len(starts), len(sym))
        np.minimum.at(end, number[stops], at[stops])
        at = at[at <= end[number]]
    return at


def _finish(vocab: Vocabulary, symbols: np.ndarray) -> list[int]:
    """The rounds of one word that still has many, its least rank kept in a heap."""
    sym = symbols.tolist()
    size = len(sym)
    before, after = list(range(-1, size - 1)), [*range(1, size), -1]
    rank, into = vocab.pair(symbols[:-1], symbols[1:])
    heap = [(r, i, sym[i], sym[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), into.tolist(), strict=True))
            if r < NEVER]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, merged = heapq.heappop(heap)
        j = after[i] if sym[i] == a else -1
        if j < 0 or sym[j] != b:
            continue
        sym[i], sym[j], after[i] = merged, -1, after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] >= 0:
                r, m = vocab.pair(np.array([sym[k]]), np.array([sym[after[k]]]))
                if r[0] < NEVER:
                    heapq.heappush(heap, (int(r[0]), k, sym[k], sym[after[k]], int(m[0])))
    return [s for s in sym if s >= 0]


def merge(vocab: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and word numbers (rising) after all merges."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    rank, into = _pairs_at(vocab, sym, word, np.arange(len(sym)))
    for _ in range(FULL_ROUNDS):
        if not len(sym):
            break
        starts = _runs_of(word)
        busy = np.repeat(np.minimum.reduceat(rank, starts) < NEVER, np.diff(np.append(starts, len(word))))
        if not busy.all():
            done.append((sym[~busy], word[~busy]))
            sym, word, rank, into = sym[busy], word[busy], rank[busy], into[busy]
            continue
        at = _chosen(vocab, sym, word, rank, into)
        sym[at] = into[at]
        stale = np.zeros(len(sym), bool)
        stale[at] = True
        stale[at[at > 0] - 1] = True
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        stale[np.maximum(at - 2, 0)] = True  # the symbol before is the left one of another merge
        sym, word, rank, into, stale = sym[keep], word[keep], rank[keep], into[keep], stale[keep]
        places = np.flatnonzero(stale)
        rank[places], into[places] = _pairs_at(vocab, sym, word, places)
    if len(sym):
        starts = np.append(_runs_of(word), len(sym))
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            rest = np.array(_finish(vocab, sym[a:b]))
            done.append((rest, np.full(len(rest), word[a])))
    sym, word = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(word, kind="stable")
    return sym[order], word[order]


def encode_words(vocab: Vocabulary, words: list[str]) -> list[bytes]:
    """The ids of each word, four bytes each, little-endian. Words are not empty."""
    if not words:
        return []
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    ends = np.cumsum([len(w) for w in words])
    cut = np.concatenate((vocab.cut(points), [True]))
    cut[ends - 1] = True
    piece = np.concatenate(([0], np.cumsum(cut)[:-1]))  # number of the part of a word that merges stay in
    sym, part = merge(vocab, vocab.symbols(points), piece)
    owner = np.searchsorted(ends, np.flatnonzero(cut), side="right")[part]
    unknown = sym >= vocab.size
    if unknown.any():
        held = [chr(c).encode("utf-8", "surrogatepass") for c in (sym[unknown] - vocab.size).tolist()]
        times = np.ones(len(sym), np.int64)
        times[unknown] = [len(h) for h in held]
        is_byte = np.repeat(unknown, times)
        sym, owner = np.repeat(sym, times), np.repeat(owner, times)
        sym[is_byte] = vocab.byte_ids[np.frombuffer(b"".join(held), np.uint8)]
    stops = 4 * np.cumsum(np.bincount(owner, minlength=len(words)))
    blob = sym.astype("<u4").tobytes()
    return [blob[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]


def _encoder(vocab: Vocabulary, begin: bool, end: bool):
    """A function from texts to their ids as bytes; it remembers the short words that it has met."""
    first = np.array([vocab.begin] if begin else [], "<u4").tobytes()
    last = np.array([vocab.end] if end else [], "<u4").tobytes()
    split = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if vocab.words_start_by_space else "(?s).+").findall
    memo: dict[str, bytes] = {}

    def run(texts: list[str]) -> list[bytes]:
        parts = [split((SPACE if vocab.dummy_prefix and t else "") + t.replace(" ", SPACE)) for t in texts]
        asked = set().union(*parts)
        if len(memo) + len(asked) > MEMO_WORDS:
            memo.clear()
        fresh = list(asked - memo.keys())
        memo.update(zip(fresh, encode_words(vocab, fresh), strict=True))
        out = [first + b"".join([memo[w] for w in p]) + last for p in parts]
        for w in fresh:
            if len(w) > MEMO_CHARS:
                del memo[w]
        return out

    return run


def decode_ids(vocab: Vocabulary, ids: np.ndarray) -> str:
    """The text of ids: pieces with their spaces, byte pieces as UTF-8, one replacement character for each stray byte."""
    ids = ids.astype(np.int64)
    if len(ids) and not (0 <= ids.min() and ids.max() < vocab.size):
        raise ValueError("ids outside the vocabulary")
    starts, sizes = vocab.surface_start[ids], vocab.surface_start[ids + 1] - vocab.surface_start[ids]
    ends = np.cumsum(sizes)
    total = int(sizes.sum())
    flat = np.frombuffer(vocab.surface, np.uint8)
    taken = flat[np.repeat(starts - (ends - sizes), sizes) + np.arange(total)].tobytes()
    seen = np.flatnonzero(sizes)
    if vocab.dummy_prefix and len(seen) and vocab.spaced[ids[seen[0]]]:
        taken, ends = taken[1:], ends - 1
    codecs.register_error("each_byte", _each_byte)
    # Bytes on two sides of a control piece never make one character.
    stops = sorted({0, len(taken), *np.maximum(ends[sizes == 0], 0).tolist()})
    return "".join([taken[a:b].decode("utf-8", "each_byte") for a, b in zip(stops, stops[1:], strict=False)])


# Spark


def _appended(df: DataFrame, source, out: str, kind: str, work) -> DataFrame:
    """``df`` with a column that ``work`` (a function from a task's list of values to results, made anew per task) computes."""
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() != out.lower()]
    # The input's columns travel as one, so that their names clash with none made here.
    rows = df.select(F.struct(*kept).alias("row"), source.alias("value")) if kept else df.select(
        F.struct(F.lit(0).alias("none")).alias("row"), source.alias("value"))
    arrow = {"string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[kind]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = work()
        for batch in batches:
            values, at, held = batch.column(1), 0, 0
            count = pc.list_value_length if pa.types.is_list(values.type) else pc.binary_length
            for i, size in enumerate(count(values).to_pylist()):
                held += size or 0
                if held >= GROUP_CHARS or i + 1 == len(values):
                    result = pa.array(task(values.slice(at, i + 1 - at).to_pylist()), arrow)
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, i + 1 - at), result], ["row", "result"])
                    at, held = i + 1, 0

    shape = StructType([rows.schema["row"], *StructType.fromDDL(f"result {kind}").fields])
    found = rows.mapInArrow(run, shape)
    return found.select(*[F.col("row")[c].alias(c) for c in df.columns if c.lower() != out.lower()],
                        F.col("result").alias(out))


def encode(docs: DataFrame, path: str, text: str = "text", out: str = "ids", begin: bool = True, end: bool = True,
           packed: bool = False) -> DataFrame:
    """The input with the ids of a text: an array, or packed as unsigned 32-bit integers, little-endian."""
    vocab = docs.sparkSession.sparkContext.broadcast(load(path))

    def work():
        run = _encoder(vocab.value, begin, end)
        if packed:
            return run
        return lambda texts: [np.frombuffer(b, "<u4").astype(np.int32) for b in run(texts)]

    return _appended(docs, whole(F.col(f"`{text}`")), out, "binary" if packed else "array<int>", work)


def decode(tokens: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The input with the text of its ids, an array or packed ones."""
    vocab = tokens.sparkSession.sparkContext.broadcast(load(path))

    def numbers(value) -> np.ndarray:
        return np.frombuffer(value, "<u4") if isinstance(value, bytes) else np.array(value or [], np.int64)

    def work():
        return lambda values: [decode_ids(vocab.value, numbers(v)) for v in values]

    return _appended(tokens, F.col(f"`{ids}`"), out, "string", work)
