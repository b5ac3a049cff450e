"""PPM against a dictionary version, toxicity on held-out rows, and awkward rows for both."""

import collections
import math
import zlib

import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridseries.llm import lm, queries, toxicity
from tests.llm.rows import ROWS, documents, nothing


class Plain:
    """Unigram and PPM by dictionaries."""

    def __init__(self, texts, order):
        self.order, self.words = order, collections.Counter()
        self.after = collections.defaultdict(collections.Counter)
        for t in texts:
            self.words.update(lm.terms(t))
            self.words[None] += 1
            s = self.symbols(t)
            for p in range(order, len(s)):
                for o in range(order + 1):
                    self.after[tuple(s[p - o: p])][s[p]] += 1

    def symbols(self, text):
        return [0] * self.order + [b + 1 for b in b" ".join(lm.terms(text))] + [0]

    def base(self, text):
        n, v = sum(self.words.values()), len(self.words)
        return sum(math.log10((self.words[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*lm.terms(text), None])

    def score(self, text):
        s, total = self.symbols(text), 0.0
        for p in range(self.order, len(s)):
            out = set()
            for o in range(self.order, -1, -1):
                seen = self.after.get(tuple(s[p - o: p]))
                if seen is None:
                    continue
                left = {x: n for x, n in seen.items() if x not in out}
                room = sum(left.values()) + len(left)
                if s[p] in left:
                    total += math.log10(left[s[p]] / room)
                    break
                if left:
                    total += math.log10(len(left) / room)
                out |= set(seen)
            else:
                total -= math.log10(lm.SYMBOLS - len(out))
        return total


@pytest.mark.parametrize("order", [0, 2, 4])
def test_ppm_against_plain_version(spark, order):
    rows = [(i, t, "s") for i, t in enumerate(["the cat sat on the mat", "The dog sat", None, "", "a mat\nfor the cat",
                                                "zebra Ünï", "the cat sat on the mat", "cats"])]
    docs = documents(spark, rows, extra=False)
    plain = Plain([t for i, t, _ in rows if i % 2 == 0], order)
    got = lm.score(docs, F.col("doc_id") % 2 == 0, order).collect()
    assert len(got) == len(rows)
    for r in got:
        text = rows[r["doc_id"]][1]
        assert r["score"] == pytest.approx(plain.score(text), rel=1e-9)
        assert r["base_score"] == pytest.approx(plain.base(text), rel=1e-9)
        assert r["n_tokens"] == len(lm.terms(text)) + 1 and r["train_tokens"] == sum(plain.words.values())
        assert r["n_known"] == sum(plain.words[w] > 0 for w in [*lm.terms(text), None])


def test_ppm_probabilities_add_up():
    plain = Plain(["abra cadabra", "abba"], 2)
    s = plain.symbols("ab")[:4]

    def of(symbol):
        out, p = set(), 1.0
        for o in (2, 1, 0):
            seen = plain.after.get(tuple(s[len(s) - o:]))
            if seen is None:
                continue
            left = {x: n for x, n in seen.items() if x not in out}
            room = sum(left.values()) + len(left)
            if symbol in left:
                return p * left[symbol] / room
            p *= len(left) / room if left else 1
            out |= set(seen)
        return p / (lm.SYMBOLS - len(out))

    assert sum(of(x) for x in range(lm.SYMBOLS)) == pytest.approx(1)


def test_ppm_of_awkward_rows(spark):
    got = lm.score(documents(spark), F.col("doc_id").isNotNull()).collect()
    assert len(got) == len(ROWS)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (1, 2, 3)} == {1}
    assert sum(r["doc_id"] is None for r in got) == 1
    assert lm.score(nothing(spark), F.lit(True)).count() == 0
    untrained = lm.score(documents(spark, [(1, "ab", "s")], False), F.lit(False)).first()
    assert untrained["score"] == pytest.approx(-3 * math.log10(lm.SYMBOLS)) and untrained["n_known"] == 0
    with pytest.raises(ValueError):
        lm.score(documents(spark), F.lit(True), 7)


def test_ppm_query(spark, small):
    got = queries.op3_scoring(spark, small).toPandas()
    docs = pd.read_parquet(f"{small}/documents.parquet")
    assert sorted(got["doc_id"]) == sorted(docs["doc_id"])
    fold = got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 1)
    assert (got["held_out"] == fold).all()


def auc(score, label):
    rank = score.rank()
    ones = label == 1
    return (rank[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = queries.op4_toxicity(spark, folder).toPandas()
    assert got["score"].between(0, 1).all() and len(got) == 1000
    assert ((got["score"] >= 0.5) == (got["predicted"] == 1)).all()
    joined = got[got["held_out"]].merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    assert auc(joined["score"], joined["toxic"]) > 0.9
    assert ((joined["predicted"] == joined["toxic"]).mean()) > 0.9


SENTENCES = [("you are a {} idiot and scum", 1), ("the {} teacher reads a book", 0), ("what a stupid {} clown", 1),
             ("we met a {} friend in town", 0)]


def biased(spark):
    """Toxic rows mostly name one group, clean ones another, so a plain fit learns the group."""
    rows, labels = [], []
    for i in range(400):
        text, toxic = SENTENCES[i % 4]
        group = ("muslim" if toxic else "christian") if i % 8 < 7 else ("christian" if toxic else "muslim")
        rows.append((i, f"{text.format(group)} today{i % 13}", "s"))
        labels.append((i, toxic))
    return documents(spark, rows, False), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_swapped_groups_change_little(spark):
    docs, labels = biased(spark)
    probe = documents(spark, [(1, "a muslim neighbour waters plants", "s"), (2, "a christian neighbour waters plants", "s")], False)

    def gap(penalty):
        model = toxicity.train(docs, labels, penalty=penalty)
        found = {r["doc_id"]: r["score"] for r in toxicity.score(probe, model).collect()}
        return abs(found[1] - found[2])

    plain, regular = gap(0.0), gap(toxicity.PENALTY)
    assert regular < plain / 3 and regular < 0.05


def test_toxicity_of_awkward_rows(spark):
    docs, labels = biased(spark)
    labels = labels.union(spark.createDataFrame([(0, None), (None, 1), (0, 0), (3, 7)], labels.schema))
    model = toxicity.train(docs, labels)
    got = toxicity.score(documents(spark), model)
    assert got.count() == len(ROWS) and len({c.lower() for c in got.columns}) == len(got.columns)
    assert got.filter("score is null or score < 0 or score > 1").count() == 0
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    assert scores[1] == scores[2] == scores[3] and scores[5] == scores[6]
    assert toxicity.score(nothing(spark), model).count() == 0
    unlabelled = toxicity.train(docs, nothing(spark, "doc_id long, toxic int"))
    assert unlabelled.weights == {} and unlabelled.intercept == 0


def test_a_shared_id_is_one_training_row(spark):
    docs = spark.range(4000).selectExpr("cast(1 as long) as doc_id", "concat('text ', id) as text").unionByName(
        spark.range(2, 50).selectExpr("id as doc_id", "concat('other ', id) as text"))
    labels = spark.range(1, 50).selectExpr("id as doc_id", "cast(id % 2 as int) as toxic", "1 as quality")
    rows = toxicity.training_rows(docs, labels, max_rows=1000).collect()
    assert len(rows) == toxicity.training_rows(docs.dropDuplicates(["doc_id"]), labels, max_rows=1000).count()
    assert sum(r["text"].startswith("text") for r in rows) <= 1
