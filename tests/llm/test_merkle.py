"""The manifest against plain trees of lists."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from gridseries.llm import merkle, queries
from tests.llm import rows

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return sha("".join("-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS))


def tree(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i: i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, i):
    out = []
    for nodes in levels[:-1]:
        run = nodes[i // 8 * 8: i // 8 * 8 + 8]
        out.append((run[: i % 8], run[i % 8 + 1:]))
        i //= 8
    return out


def plain(docs):
    """(doc_id, leaf, subroot, root, proof hash, folded root, verified) of every row, sorted."""
    groups = {}
    for d in docs:
        groups.setdefault(d["lang"], []).append((d["doc_id"] is not None, d["doc_id"] or 0, leaf(d), d))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (_, _, own, d) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps, changed = siblings(trees[g], i) + siblings(top, k), dict(d)
            if d["doc_id"] is not None and d["text"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 3 == 0:
                changed["text"] = "".join(c.lower() if "A" <= c <= "Z" else c for c in d["text"])
            folded = leaf(changed)
            for before, after in steps:
                folded = sha("".join(before) + folded + "".join(after))
            joined = "".join("".join(b + a) for b, a in steps)
            out.append((d["doc_id"], own, trees[g][-1][0], top[-1][0], sha(joined), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def queried(spark, docs, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    return sorted((tuple(r) for r in queries.op13_merkle(spark, "").collect()), key=repr)


@pytest.mark.parametrize("leaves", [3, 64, 8192])
def test_query_on_small_tables(spark, small, monkeypatch, leaves):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    monkeypatch.setattr(merkle, "LEAVES", leaves)
    monkeypatch.setattr(merkle, "RANGE_ROWS", 50)
    assert queried(spark, docs, monkeypatch) == plain([r.asDict() for r in docs.collect()])


def test_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 4)
    docs = rows.documents(spark).withColumn("lang", F.when(F.col("doc_id") > 4, F.col("source"))).withColumns(
        {"row": F.lit(1), "grp": F.lit("g"), "number": F.lit(2), "part": F.lit(3), "digest": F.lit("d"), "Leaf": F.lit(4)})
    docs = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("long")))
    assert queried(spark, docs, monkeypatch) == plain([r.asDict() for r in docs.collect()])
    found = merkle.manifest(docs, FIELDS, carry=docs.columns)
    assert [c for c in docs.columns if c != "Leaf"] + ["leaf", "subroot", "root", "proof", "path"] == found.columns
    again = found.withColumn("back", merkle.fold(F.col("leaf"), F.col("proof"), F.col("path")))
    assert again.filter("back = root").count() == docs.count() and again.filter("n_words <> 'x'").count() == 0
    assert merkle.manifest(rows.nothing(spark), FIELDS).count() == 0
    one = docs.filter("doc_id = 8").limit(1)
    assert [(r["leaf"], r["proof"]) for r in merkle.manifest(one, FIELDS).collect()] == [
        (merkle.manifest(one, FIELDS).first()["root"], "")]


def test_many_groups_and_a_hot_one(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEAVES", 16)
    monkeypatch.setattr(merkle, "RANGE_ROWS", 40)
    docs = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("Text").alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("l"), F.col("id"))).alias("lang"),
        F.lit("s").alias("source"), F.lit(None).cast("long").alias("n_chars"))
    assert queried(spark, docs, monkeypatch) == plain([r.asDict() for r in docs.collect()])


def test_a_partition_fetches_few_nodes():
    for start, count, total in ((0, 8192, 8192), (8190, 8192, 10**9), (5, 1, 6), (10**6, 1, 10**6 + 1), (64, 64, 4096)):
        found = merkle.missing(start, count, total)
        assert len(found) == len(set(found)) <= 14 * merkle.levels_above(total)
    assert merkle.missing(0, 4096, 4096) == []
