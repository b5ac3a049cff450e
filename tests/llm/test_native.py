"""Quality rules, licenses and line dedup: SQL, plain versions, and awkward rows."""

import dataclasses
import itertools
import random
import re
import time

import pytest

import check
from gridseries.llm import licenses, lines, quality, queries, sql
from tests.llm.rows import ROWS, documents, nothing


@pytest.fixture(scope="module")
def duck(small):
    return check.connect(small)


@pytest.mark.parametrize("name", sorted(sql.all_sql()))
def test_against_sql(spark, small, duck, name):
    ours = queries.all_queries()[name](spark, small).toPandas()
    assert len(ours)
    assert check.difference(ours, duck.execute(sql.all_sql()[name]).df()) is None


def test_quality_of_awkward_rows(spark):
    judged = quality.apply_policy(quality.measure(documents(spark)))
    found = {(r["doc_id"], r["n_words"]): r for r in judged.collect()}
    assert judged.count() == len(ROWS)
    assert len(set(c.lower() for c in judged.columns)) == len(judged.columns)
    for i in (1, 2, 3):
        assert found[i, 0]["failures"] & quality.BITS["short"] and not found[i, 0]["kept"]
    assert found[4, 30_000]["kept"] is not None
    assert found[5, 240]["failures"] == found[6, 240]["failures"]
    assert quality.measure(nothing(spark)).count() == 0


def test_ablation_counts_rules_that_decide_alone(spark):
    ledger = quality.measure(documents(spark, extra=False))
    rows = {r["rule"]: r for r in quality.ablation(ledger).collect()}
    judged = quality.apply_policy(ledger).toPandas()
    assert rows["short"]["n_rejected"] == (~judged["kept"]).sum()
    alone = judged[judged["failures"] == quality.BITS["short"]]
    assert rows["short"]["n_decided_alone"] == len(alone)
    assert [r["n_rows"] for r in quality.ablation(quality.measure(nothing(spark))).collect()] == [0] * len(rows)


def test_long_clean_texts_are_kept(spark, monkeypatch):
    """A long text whose share of distinct words falls below 15 % by its length alone, and junk of every length."""
    draw = random.Random(6)
    book = " ".join(f"word{draw.randrange(6000)}" for _ in range(60_000))
    junk = [" ".join(f"word{draw.randrange(60)}" for _ in range(n)) for n in (3000, 4097, 8191, 60_000)]
    rows = [(i, t, "s") for i, t in enumerate([book, *junk])]
    judged = {r["doc_id"]: r for r in quality.apply_policy(quality.measure(documents(spark, rows, extra=False))).collect()}
    assert judged[0]["n_distinct_words"] * 100 < 15 * judged[0]["n_words"]
    assert [judged[i]["kept"] for i in range(5)] == [True, False, False, False, False]
    monkeypatch.setattr(queries, "table", lambda *_: documents(spark, rows, extra=False))
    asked = {r["doc_id"]: r["kept"] for r in queries.op2_quality(spark, "").collect()}
    assert asked == {i: r["kept"] for i, r in judged.items()}
    words, size = book.split(), quality.DISTINCT_WINDOW
    starts = [min(k * size, 60_000 - size) for k in range(15)]
    assert judged[0]["n_window_distinct"] == sum(len(set(words[i: i + size])) for i in starts)
    assert judged[0]["n_window_words"] == 15 * size


def test_policies_only_read_bits(spark):
    ledger = spark.createDataFrame([(b,) for b in (0, 1, 4, 128, 128 + 256)], "failures long")
    kept = [r["kept"] for r in quality.apply_policy(ledger, "v1").orderBy("failures").collect()]
    assert kept == [True, False, False, True, False]
    assert [r["kept"] for r in quality.apply_policy(ledger, "base").orderBy("failures").collect()] == [
        True, False, True, True, True]


def plain_terms(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain_scan(text):
    """Base places and the detections left, by the definition."""
    words = plain_terms(text)
    line = " " + " ".join(words) + " "
    base = [(i, label) for phrase, label in licenses.BASE_PHRASES for i in range(len(words))
            if words[i: i + len(phrase.split())] == phrase.split()]
    found = []
    for no, rule in enumerate(licenses.rules()):
        if all(k in words for k in rule.keywords):
            for m in re.finditer(rf"(?<= )(?:{rule.pattern})(?= )", line):
                first = line[: m.start()].count(" ") - 1
                found.append((first, first + m[0].count(" "), rule.priority, no, rule.label))

    def hides(o, d):
        if o is d or o[0] > d[0] or o[1] < d[1]:
            return False
        return o[2] > d[2] or o[2] == d[2] and ((o[1] - o[0], -o[3]) > (d[1] - d[0], -d[3]))

    return sorted(base), sorted(d for d in found if not any(hides(o, d) for o in found))


LICENSED = """Licensed under the Apache License, Version 2.0. SPDX-License-Identifier: GPL-2.0 or later.
under the terms of the GNU Lesser General Public License, version 2.1. All rights reserved. CC BY CC BY-NC-SA 4.0
Redistribution and use in source and binary forms, with or without modification. https://opensource.org/licenses/MIT
released under the MIT License or the GNU General Public License v3.0; Copyright (c) 2020 2021, BSD 3-Clause"""


def test_license_scan_against_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    extra = documents(spark, [(10**6 + i, x, "s") for i, x in enumerate([LICENSED, LICENSED * 3, None, "", "cc by"])], False)
    for row in licenses.scan(docs.union(extra.select("doc_id", "text"))).collect():
        base, kept = plain_scan(row["text"])
        assert [(b["place"], b["label"]) for b in row["base_places"]] == base
        assert sorted((d["first"], d["last"], d["priority"], d["rule"], d["label"]) for d in row["detections"]) == kept
        assert row["n_words"] == len(plain_terms(row["text"]))


def samples(pattern):
    """Texts that a pattern matches: all choices, repeats as few times as they may and once more."""
    def of(item):
        op, value = str(item[0]), item[1]
        if op == "LITERAL":
            return [chr(value)]
        if op == "IN":
            return [chr(v) for k, v in value if str(k) == "LITERAL"] or ["7" if "DIGIT" in str(value) else "q"]
        if op == "BRANCH":
            return [s for branch in value[1] for s in joined(branch)]
        if op == "SUBPATTERN":
            return joined(value[3])
        low, high, inside = value
        return ["".join(c) for n in sorted({low, min(low + 1, high)}) for c in itertools.product(joined(inside), repeat=n)]

    def joined(items):
        found = [""]
        for item in items:
            found = [a + b for a in found for b in of(item)]
        return found

    return joined(re._parser.parse(pattern))


def test_gates_drop_no_license(spark, monkeypatch):
    """The scan of texts that the patterns match, against all patterns without gates."""
    table, texts = licenses.rules(), []
    for rule in table:
        if not rule.pattern.startswith(licenses._GRANTED):
            found = samples(rule.pattern)
            assert all(re.fullmatch(rule.pattern, s) for s in found)
            assert all(any(set(g) <= set(s.split()) for g in rule.gates) for s in found)
            texts += found[:: max(1, len(found) // 12)] + [f"it is licensed under the {found[-1]}"]
    frame = documents(spark, [(i, x, "s") for i, x in enumerate(texts)], extra=False)
    scanned = licenses.scan(frame).collect()
    open_table = [dataclasses.replace(r, keywords=(), alternatives=()) for r in table]
    monkeypatch.setattr(licenses, "rules", lambda: open_table)
    for row in scanned:
        assert sorted((d["first"], d["last"], d["priority"], d["rule"], d["label"]) for d in row["detections"]) == (
            plain_scan(row["text"])[1])


def test_license_rules():
    table = licenses.rules()
    assert len(table) > 200
    for rule in table:
        assert re.compile(rule.pattern) and not re.fullmatch(rule.pattern, "")
    text = " ".join(plain_terms("Licensed under the Mozilla Public License, v. 2.0"))
    assert [r.label for r in table if re.fullmatch(r.pattern, text)] == ["mpl-2.0"]


def test_license_scan_of_awkward_rows(spark):
    found = licenses.scan(documents(spark))
    assert found.count() == len(ROWS)
    assert found.filter("size(detections) > 0 or size(base_places) > 0").count() == 0
    assert licenses.scan(nothing(spark)).count() == 0


def test_line_dedup_of_awkward_rows(spark):
    done = {(r["doc_id"], r["source"]): r for r in lines.dedup(documents(spark)).collect()}
    assert done[5, "t"]["removed_lines"] == []  # a repeated row does not delete itself
    assert done[6, "u"]["removed_lines"] == [0, 1, 2, 3] and done[6, "u"]["text"] == ""
    assert done[7, "t"]["text"] == "and one more line of its own here"
    assert done[1, "s"]["text"] == "" and done[2, "s"]["text"] == ""
    assert done[4, "s"]["removed_lines"] == []
    assert lines.dedup(nothing(spark)).count() == 0


def test_lines_are_matched_beyond_their_windows(spark):
    def words(name, n):
        return " ".join(f"{name}{i}" for i in range(n))

    head, body, tail = words("h", 10), words("b", 55), words("t", 12)
    docs = documents(spark, [(1, "\n".join([head, body, tail]), "s"),
                             (2, "\n".join([words("x", 60), head, "", body, tail, words("y", 9)]), "s"),
                             (3, "\n".join([tail, words("z", 60)]), "s"),
                             (4, "\n".join([body, words("q", 60), body]), "s")], extra=False)
    found = {r["doc_id"]: r["removed_lines"] for r in lines.dedup(docs).collect()}
    assert found == {1: [], 2: [1, 3, 4], 3: [], 4: [0, 2]}


def test_repeats_within_a_text(spark):
    row = "again " * 60
    docs = documents(spark, [(1, "\n".join([row] * 5 + ["end"]), "s")], extra=False)
    assert lines.dedup(docs).first()["removed_lines"] == [1, 2, 3, 4]



def seconds(run):
    started = time.perf_counter()
    run()
    return time.perf_counter() - started


def test_many_detections_cost_what_prose_costs(spark):
    def scanned(text):
        docs = documents(spark, [(1, text, "s")], extra=False)
        return lambda: found.append(licenses.scan(docs).first())

    found = []
    scanned("warm up with the mit license")()
    prose = seconds(scanned("amber tree fox bar baz " * 8000))
    named = seconds(scanned("mit license foo bar baz " * 8000))
    assert len(found[2]["detections"]) == 8000
    assert [(d["first"], d["last"]) for d in found[2]["detections"][-2:]] == [(5 * 7998, 5 * 7998 + 1), (5 * 7999, 5 * 7999 + 1)]
    assert named < 10 * prose + 5


def test_fingerprints_are_fewer_than_lines_and_find_shifted_runs(spark):
    rng = random.Random(2)
    run = [" ".join(f"w{rng.randrange(9999)}" for _ in range(rng.randrange(1, 7))) for _ in range(40)]
    fill = [[" ".join(f"x{rng.randrange(9999)}" for _ in range(5)) for _ in range(n)] for n in (30, 17, 55)]
    docs = documents(spark, [(i, "\n".join(f + run + f[:3]), "s") for i, f in enumerate(fill)], extra=False)
    lined, prints = lines.fingerprints(docs)
    assert prints.count() < sum(len(r["lines"]) for r in lined.collect()) / 2
    removed = {r["doc_id"]: list(r["removed_lines"]) for r in lines.dedup(docs).collect()}
    assert removed == {0: [], 1: list(range(17, 57)), 2: list(range(55, 95))}


def test_equal_minima(spark):
    """One line repeated: every window has the same least hash at every place."""
    line = "the same eight words stand in every line"
    docs = documents(spark, [(1, "\n".join([line] * 30), "s"), (2, "\n".join([line] * 21 + ["end of it"]), "s"),
                             (3, "\n".join([line] * 6), "s")], extra=False)
    assert {r["doc_id"] for r in lines.fingerprints(docs)[1].collect()} == {1, 2}  # the third text has too few words
    removed = {r["doc_id"]: list(r["removed_lines"]) for r in lines.dedup(docs).collect()}
    assert removed == {1: list(range(1, 30)), 2: list(range(21)), 3: []}


def test_long_texts_of_lines_take_linear_time(spark):
    def deduped(n):
        text = "\n".join(f"line {i} of words that stand in two texts" for i in range(n))
        docs = documents(spark, [(1, text, "s"), (2, text + "\nmore", "s")], extra=False)
        return lambda: found.append(lines.dedup(docs).filter("size(removed_lines) > 0").count())

    found = []
    deduped(100)()
    short, long = seconds(deduped(4000)), seconds(deduped(32_000))
    assert found == [1, 1, 1] and long < 8 * short + 10
