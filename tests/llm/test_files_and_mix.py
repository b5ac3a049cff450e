"""Mixing, url filter and archives."""

import base64
import hashlib
import math

import pandas as pd
import pytest

from gridseries.llm import mixing, queries, urls, warc
from gridseries.llm.scratch import folder
from tests.llm.rows import ROWS, documents, nothing


def test_targets():
    assert mixing.targets([100, 100, 100], [1.0, 2.0, 3.0]) == [50.0, 100.0, 150.0]
    assert mixing.targets([1000, 10, 10], [1.0, 2.0, 3.0]) == [960.0, 30.0, 30.0]
    assert mixing.targets([], []) == [] and mixing.targets([0, 5], [1.0, 1.0]) == [0.0, 5.0]
    found = mixing.targets([500, 20, 300, 7], [1.0, 2.0, 3.0, 1.0])
    assert sum(found) == pytest.approx(827) and all(t <= 3 * s for t, s in zip(found, [500, 20, 300, 7], strict=True))


def test_shard_quotas_add_up_and_repeat():
    total, shards = (700, 3, 0, 41), 13
    leaf, again = mixing.shard_quotas(total, shards, 5), mixing.shard_quotas(total, shards, 5)
    before = [0] * len(total)
    for shard in range(shards):
        first, own = leaf(shard)
        assert (first, own) == again(shard) and list(first) == before
        before = [b + o for b, o in zip(before, own, strict=True)]
    assert tuple(before) == total
    assert {sum(leaf(s)[1]) for s in range(shards)} <= {sum(total) // shards, sum(total) // shards + 1}


def test_splits_follow_the_hypergeometric_mean():
    got = [mixing.split((600, 300, 100), 100, (i,)) for i in range(300)]
    assert all(sum(g) == 100 for g in got)
    for k, mean in enumerate((60, 30, 10)):
        assert abs(sum(g[k] for g in got) / len(got) - mean) < 1.5


def test_permutations_hit_every_block():
    for blocks in (1, 2, 9, 64, 1000):
        factor, shift = mixing.permutation(3, blocks, 1, 11)
        assert sorted((b * factor + shift) % blocks for b in range(blocks)) == list(range(blocks))


def test_mix_query(spark):
    path = "/root/testdata/sf0.01"
    got = queries.op1_mixing(spark, path).toPandas().sort_values("doc_id", ignore_index=True)
    again = queries.op1_mixing(spark, path).toPandas().sort_values("doc_id", ignore_index=True)
    assert got["taken"].tolist() == again["taken"].tolist()
    docs = pd.read_parquet(f"{path}/documents.parquet")
    size = dict(zip(docs["doc_id"], docs["text"].map(lambda t: len(t.encode().split())), strict=True))
    assert (got["size"] == got["doc_id"].map(size)).all() and (got["taken"] <= 3 * got["size"]).all()
    got["source"] = got["doc_id"].map(dict(zip(docs["doc_id"], docs["source"], strict=True)))
    by = got.groupby("source").agg(size=("size", "sum"), given=("source_size", "first"), target=("target", "first"),
                                   taken=("taken", "sum")).sort_index()
    assert (by["size"] == by["given"]).all()
    weights = [1 + i % 3 for i in range(len(by))]
    assert by["target"].tolist() == pytest.approx(mixing.targets(by["size"].tolist(), weights))
    assert ((by["taken"] - by["target"]).abs() <= got.groupby("source")["size"].max().sort_index()).all()
    assert by["target"].sum() == pytest.approx(by["size"].sum())


def by_source(mixed):
    return mixed.groupby("source", dropna=False).agg(target=("target", "first"), taken=("taken", "sum"), most=("size", "max"))


@pytest.mark.parametrize("kind", ["null", "shared", "repeated"])
def test_target_met_with_a_third_of_rows_alike(spark, kind):
    def row(i):
        if i % 3:
            return i, "w " * (1 + i % 40), "abc"[i % 5 % 3]
        return {"null": (None, "w " * (1 + i % 40), "abc"[i % 5 % 3]), "shared": (7, f"x{i} " * (1 + i % 40), "abc"[i % 5 % 3]),
                "repeated": (7, "w " * 20, "a")}[kind]

    docs = documents(spark, [row(i) for i in range(9000)], extra=False).repartition(5)
    mixed = mixing.mix(docs).toPandas()
    assert len(mixed) == 9000 and (mixed["taken"] <= 3 * mixed["size"]).all()
    for _, r in by_source(mixed).iterrows():
        assert abs(r["taken"] - r["target"]) <= r["most"]
    again = mixing.mix(docs.repartition(3)).toPandas()
    columns = ["source", "size", "taken"]
    assert again[columns].value_counts().to_dict() == mixed[columns].value_counts().to_dict()


def test_the_draw_against_a_plain_one(spark):
    """Blocks and ranks as hashed; cut, quotas, shards and the greedy fill anew from lists."""
    rows = [(None if i % 3 == 0 else i % 900, "w " * (1 + i % 50), ["a", "b", None][i % 7 % 3]) for i in range(2000)]
    docs = documents(spark, rows, extra=False)
    mixed = mixing.mix(docs, shard_blocks=3)
    sized = docs.select("*", mixing.word_count(docs["text"]).alias("size"))
    h1, h2 = mixing._identity(docs, mixing.SEED)
    counted = sized.select("source", "size", h1.alias("h1"), h2.alias("h2"))
    repeated = counted.groupBy("h1", "h2").count().withColumnRenamed("count", "times").filter("times > 1")
    sources = mixing.survey(counted, 3.0)
    keyed = mixing._keyed(mixing._numbered(counted, repeated), sources, mixing.SEED).withColumn(
        "rank", mixing._rank(mixing.SEED)).toPandas()
    assert len(keyed) == 2000 and not keyed.duplicated(["h1", "h2", "number"]).any()
    expected = []
    for i, s in enumerate(sources):
        mine = keyed[keyed["source_no"] == i]
        factor, shift = mixing.permutation(i, s.blocks, s.passes, mixing.SEED)
        due, taken = s.rest, {}
        for place in range(s.blocks):
            block = next(b for b in range(s.blocks) if (b * factor + shift) % s.blocks == place)
            inside = mine[mine["block"] == block].sort_values("rank")
            whole = inside["size"].sum() < due
            for at, size in zip(inside.index, inside["size"], strict=True):
                if whole or 0 < size <= due:
                    taken[at] = 1
                    due -= 0 if whole else size
            if not whole:
                break
            due -= inside["size"].sum()
        expected += [(int(k), int(k) * (s.passes + taken.get(j, 0))) for j, k in zip(mine.index, mine["size"], strict=True)]
    got = mixed.toPandas()
    assert sorted(zip(got["size"], got["taken"], strict=True)) == sorted(expected)
    placed = [(p["shard"], p["order"]) for r in got["placed"] for p in r]
    assert len(placed) == len(set(placed))


def test_shards_hold_what_was_taken(spark):
    docs = documents(spark, [(i, "w " * (1 + i % 50), "ab"[i % 7 > 4]) for i in range(600)])
    mixed = mixing.mix(docs, shard_blocks=1)
    copies = mixing.shards(mixed).toPandas()
    assert len(copies.columns) == len({c.lower() for c in copies.columns})
    taken = mixed.toPandas().set_index("doc_id")["taken"]
    assert copies.groupby("doc_id")["size"].sum().reindex(taken.index, fill_value=0).tolist() == taken.tolist()
    assert not copies.duplicated(["doc_id", "order"]).any()


def test_mix_of_awkward_rows(spark):
    mixed = mixing.mix(documents(spark)).toPandas()
    assert len(mixed) == len(ROWS) and (mixed["taken"] <= 3 * mixed["size"]).all()
    named = sorted({r[2] for r in ROWS if r[2] is not None})
    sizes = {s: sum(len((t or "").encode().split()) for _, t, x in ROWS if x == s) for s in [*named, None]}
    wanted = mixing.targets(list(sizes.values()), [1 + i % 3 for i in range(len(sizes))])
    for (source, size), target in zip(sizes.items(), wanted, strict=True):
        rows = mixed[mixed["source"].isna() if source is None else mixed["source"] == source]
        assert set(rows["source_size"]) == {size} and rows["target"].iloc[0] == pytest.approx(target)
    assert mixing.mix(nothing(spark)).count() == 0


URLS = [
    ("https://www.EXAMPLE.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/casino", "m.example.com", "/en/casino", "example.com/en/", "block"),
    ("http://casino.example.com/de", "casino.example.com", "/de", "com/", "allow"),
    ("http://a.net/es/", "a.net", "/es/", "net/es/", "block"), ("http://a.net/es", "a.net", "/es", None, "allow"),
    ("http://b.org/casino-win", "b.org", "/casino-win", None, "block"),
    ("http://b.org/casinoland", "b.org", "/casinoland", None, "allow"),
    ("http://free.b.org/x", "free.b.org", "/x", None, "allow"),
    ("http://free.b.org/win/win", "free.b.org", "/win/win", None, "block"),
    ("http://free-free.b.org/", "free-free.b.org", "/", None, "allow"),
    ("no scheme casino", "", "", None, "block"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("http://x.com", "x.com", "", None, "allow"), ("http://telecom/", "telecom", "/", None, "allow"),
    ("http://b.org/" + "a" * 100_000 + "/porn", "b.org", "/" + "a" * 100_000 + "/porn", None, "block"),
]


def test_urls(spark):
    rows = [(i, u, "x") for i, (u, *_) in enumerate(URLS)] + [(None, "http://a.net/fr/", "x"), (0, URLS[0][0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, Verdict string")
    got = urls.judge(pages).collect()
    assert len(got) == len(rows) and len(got[0]) == 8
    for r in got:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"], r["verdict"]) == URLS[r["page_id"]][1:]
        else:
            assert r["rule"] == "net/fr/" and r["verdict"] == "block"
    assert urls.judge(pages.limit(0)).count() == 0
    assert urls.judge(pages, rules=(), strict=(), soft=()).filter("verdict = 'block'").count() == 0


PAGES = [(1, "http://a/ b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://ü", None), (4, "u", ""), (None, "n", "lone"),
         (5, "v", "<p>x</p>"), (5, "v", "<p>x</p>"), (6, "w", "\r\n\r\nWARC/1.1\r\n\n\n" * 9), (7, "z", "long é" * 200_000)]


@pytest.mark.parametrize("versions", ["1", "2"])
def test_archives_round_trip(spark, versions):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    place = folder(spark)
    warc.write_arcs(pages, f"{place}/arc", versions)
    got = warc.convert(spark, f"{place}/arc", f"{place}/warc").toPandas()
    assert len(got) == len(PAGES) and got["record_id"].is_unique
    for page, _, html in PAGES:
        data = (html or "").encode()
        mine = got[got["page_id"].isna() if page is None else got["page_id"] == page]
        assert set(mine["payload_bytes"]) == {len(data)}
        assert set(mine["payload_digest"]) == {base64.b32encode(hashlib.sha1(data).digest()).decode()}
        for payload in mine[mine["record_type"] == "response"]["payload"]:
            assert bytes(payload) == data
    type_of = got.groupby("page_id")["record_type"].apply(sorted).to_dict()
    assert type_of == {1: ["revisit"], 2: ["revisit"], 3: ["revisit"], 4: ["response"], 5: ["response", "revisit"],
                       6: ["response"], 7: ["response"]}
    refers = got[got["record_type"] == "revisit"].set_index("page_id")["refers_to"].to_dict()
    assert refers == {1: 5, 2: 5, 3: 4, 5: 5}
    kept = set(got[got["record_type"] == "response"]["record_id"])
    assert set(got["refers_to_record"].dropna()) <= kept
    alone = warc.convert(spark, f"{place}/arc", f"{place}/warc10", min_revisit_bytes=9).toPandas()
    assert (alone["record_type"] == "response").all()


def test_empty_archives(spark):
    place = folder(spark)
    warc.write_arcs(spark.createDataFrame([], "page_id long, url string, html string"), f"{place}/arc")
    assert warc.convert(spark, f"{place}/arc", f"{place}/warc").count() == 0


def test_archive_headers():
    for version in "12":
        data = warc.arc_version_block("x", version) + b"\n" + warc.arc_record(version, "x", "http://a b\n", b"block\n")
        (_, fields, block), = warc.parse_arc(data)
        assert block == b"block\n" and fields["URL"] == "http://a%20b%0A" and fields["Archive-length"] == "6"
        assert ("Checksum" in fields) == (version == "2")
    with pytest.raises(ValueError, match="declares"):
        list(warc.parse_arc(data[:-3]))
    with pytest.raises(ValueError, match="version"):
        list(warc.parse_arc(data.replace(b"2 0 grid", b"9 0 grid")))
    with pytest.raises(ValueError, match="version block"):
        list(warc.parse_arc(b"http://a 1 2 text/html 1\nx"))


def test_archives_are_cut(spark, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    pages = spark.createDataFrame([(i, f"u{i}", "x" * (i % 7 * 300)) for i in range(60)], "page_id long, url string, html string")
    place = folder(spark)
    warc.write_arcs(pages.coalesce(1), f"{place}/arc")
    assert warc.archives(spark, f"{place}/arc").count() >= math.ceil(60 * 900 / 2000) - 5
    assert warc.read_arcs(spark, f"{place}/arc").count() == 60
