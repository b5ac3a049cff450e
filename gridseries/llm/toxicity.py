"""Toxicity by a counterfactual-regularised classifier.

A text is the set of its words' pieces: each word whole, and its runs of 3 to 6 bytes with the word's ends marked.
A logistic model over pieces is fitted on at most ``MAX_ROWS`` labelled rows, chosen by a hash of their id (all if there are
fewer). Pieces are first counted over those rows by label, and the ``MAX_PIECES`` that tell the labels apart best are kept.
Each row that names a group of people is also scored with the term swapped for others of its kind, and the fit pays
for every change of score that this makes, so that neutral mentions of a group do not count against a text.

Null and empty texts have no pieces and get the model's intercept. Very long texts are read whole. Rows are scored one by
one, so repeated rows get equal scores; of repeated labels the highest counts, labels other than 0 and 1 do not. A null id has no label.
Without labels of both kinds the score is the smoothed share of toxic rows. An empty table gives an empty result.
Only the text is an input of the score; columns of the input that bear the name of a result column are replaced.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridseries.llm.scratch import stored

MAX_ROWS = 16_000
MAX_PIECES = 4096
LEAST_ROWS = 3
PENALTY = 1.0
DECAY = 2e-4
STEPS = 150
CACHE = 200_000

# Terms for groups of people, by kind. A term is swapped for the others of its kind and line.
IDENTITIES = tuple(tuple(line.split()) for line in """
    muslim christian jewish hindu buddhist atheist catholic protestant sikh
    muslims christians jews hindus buddhists atheists catholics protestants sikhs
    gay straight lesbian bisexual heterosexual homosexual transgender queer
    woman man
    women men
    girl boy
    girls boys
    black white asian african european american mexican latino arab
    immigrant refugee foreigner migrant citizen
    immigrants refugees foreigners migrants citizens
    disabled blind deaf
    old young elderly
    frau mann
    frauen maenner
    musulman chretien juif
    femme homme
    femmes hommes
    mujer hombre
    mujeres hombres
    musulmanes cristianos judios
""".strip().splitlines())

_WORDS = re.compile(r"[^\W_]+")


def identity_swaps() -> dict[str, tuple[str, ...]]:
    return {term: tuple(t for t in line if t != term) for line in IDENTITIES for term in line}


def distinct_words(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


def pieces(word: str) -> set[int]:
    """32-bit hashes of a word and of its byte runs."""
    marked = f"<{word}>".encode("utf-8", "surrogatepass")
    found = {zlib.crc32(marked)}
    for n in range(3, 7):
        found.update(zlib.crc32(marked[i: i + n]) for i in range(len(marked) - n + 1))
    return found


@dataclass(frozen=True)
class Model:
    intercept: float
    weights: dict[int, float]


def training_rows(docs: DataFrame, labels: DataFrame, fold: int = 0, max_rows: int = MAX_ROWS) -> DataFrame:
    """(text, toxic) of labelled rows outside the held-out fold, at most about ``max_rows``, chosen by hash."""
    known = labels.filter("doc_id is not null and toxic in (0, 1)").filter(
        F.crc32(F.col("doc_id").cast("string")) % 5 != fold).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = stored(known)
    share = min(1.0, max_rows / max(known.count(), 1))
    spread = F.pmod(F.xxhash64(F.lit("toxicity"), F.col("doc_id")), F.lit(1 << 20))
    chosen = known.filter(spread < int(share * (1 << 20)))
    labelled = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # max_rows bounds the chosen labels, so an id that many documents share gives one of their texts, by hash.
    return labelled.groupBy("doc_id", F.col("toxic").cast("int").alias("toxic")).agg(
        F.min_by("text", F.xxhash64("text")).alias("text")).select("text", "toxic")


def telling_pieces(rows: DataFrame, toxic: int, clean: int, most: int = MAX_PIECES) -> list[int]:
    """The pieces whose share differs most between the labels, in standard errors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def table() -> pd.DataFrame:
            return pd.DataFrame({"piece": np.fromiter(found, np.int64, len(found)),
                                 "t": [x[1] for x in found.values()], "c": [x[0] for x in found.values()]})

        found: dict[int, list[int]] = {}
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                for p in set().union(*map(pieces, distinct_words(text))):
                    found.setdefault(p, [0, 0])[label] += 1
                if len(found) > CACHE:
                    yield table()
                    found = {}
        yield table()

    counts = rows.mapInPandas(run, "piece long, t long, c long").groupBy("piece").agg(
        F.sum("t").alias("t"), F.sum("c").alias("c")).filter(F.col("t") + F.col("c") >= LEAST_ROWS)
    gap = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("c") + 0.5) / (clean + 1.0))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    best = counts.withColumn("z", F.abs(gap / error)).filter("z > 3").orderBy(F.desc("z"), "piece").limit(most)
    return [r["piece"] for r in best.select("piece").collect()]


def featured(rows: DataFrame, chosen: list[int]) -> DataFrame:
    """(toxic, pieces, swapped): the chosen pieces of each row, and per swap of a group's term those of the new text."""
    swaps, wanted = identity_swaps(), frozenset(chosen)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own, other = [], []
            for text in batch["text"]:
                by_word = {w: pieces(w) & wanted for w in distinct_words(text)}
                own.append(sorted(set().union(*by_word.values())))
                changed = []
                for term in sorted(by_word.keys() & swaps.keys()):
                    rest = set().union(*(p for w, p in by_word.items() if w != term))
                    changed += [sorted(rest | (pieces(t) & wanted)) for t in swaps[term]]
                other.append(changed)
            yield pd.DataFrame({"toxic": batch["toxic"], "pieces": own, "swapped": other})

    return rows.mapInPandas(run, "toxic int, pieces array<long>, swapped array<array<long>>")


def _gather(rows: list[list[int]], place: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    row, column = [], []
    for i, found in enumerate(rows):
        inside = [place[p] for p in found if p in place]
        row += [i] * len(inside)
        column += inside
    return np.array(row, np.int64), np.array(column, np.int64)


def fit(labels: np.ndarray, rows: list[list[int]], swapped_of: np.ndarray, swapped: list[list[int]], chosen: list[int],
        penalty: float = PENALTY, decay: float = DECAY, steps: int = STEPS) -> Model:
    """Logistic loss, squared weights, and the squared change of logit under swaps, by Adam over all rows."""
    n, positive = len(labels), float(labels.sum())
    prior = math.log((positive + 0.5) / (n - positive + 0.5))
    if not n or positive in (0.0, float(n)) or not chosen:
        return Model(prior, {})
    place = {p: i for i, p in enumerate(chosen)}
    size = len(chosen)
    r, c = _gather(rows, place)
    sr, sc = _gather(swapped, place)
    w, b = np.zeros(size), prior
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        logit = np.bincount(r, w[c], n) + b
        wrong = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels
        grad = np.bincount(c, wrong[r], size) / n + decay * w
        if len(swapped):
            change = np.bincount(sr, w[sc], len(swapped)) + b - logit[swapped_of]
            pull = np.bincount(swapped_of, change, n)
            grad += 2 * penalty * (np.bincount(sc, change[sr], size) - np.bincount(c, pull[r], size)) / len(swapped)
        full = np.append(grad, wrong.mean())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full * full
        move = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return Model(float(b), {p: float(x) for p, x in zip(chosen, w, strict=True)})


def train(docs: DataFrame, labels: DataFrame, fold: int = 0, max_rows: int = MAX_ROWS, max_pieces: int = MAX_PIECES,
          penalty: float = PENALTY) -> Model:
    rows = stored(training_rows(docs, labels, fold, max_rows))
    totals = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    chosen = telling_pieces(rows, totals["t"], totals["n"] - totals["t"], max_pieces)
    slim = featured(rows, chosen).collect()  # about max_rows rows of at most max_pieces numbers
    swapped = [(i, s) for i, row in enumerate(slim) for s in row["swapped"]]
    return fit(np.array([r["toxic"] for r in slim], float), [r["pieces"] for r in slim],
               np.array([i for i, _ in swapped], np.int64), [s for _, s in swapped], chosen, penalty)


def _scorer(weights: dict[int, float], intercept: float):
    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo: dict[str, tuple[int, ...]] = {}
        for batch in batches:
            out = []
            for text in batch:
                found: set[int] = set()
                for word in distinct_words(text):
                    inside = memo.get(word)
                    if inside is None:
                        if len(memo) >= CACHE:
                            memo.clear()
                        inside = memo[word] = tuple(p for p in pieces(word) if p in weights)
                    found.update(inside)
                logit = intercept + math.fsum(weights[p] for p in found)
                out.append(1 / (1 + math.exp(-max(-30.0, min(30.0, logit)))))
            yield pd.Series(out, dtype="float64")

    return scores


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The input with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on). The model has at most MAX_PIECES weights."""
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*kept, _scorer(model.weights, model.intercept)(F.col(f"`{text}`").cast("string")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
