"""SimHash groups, components and decontamination against plain versions, and awkward rows."""

import collections
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash

from gridseries.llm import decontaminate, queries, simhash
from gridseries.llm.components import components
from gridseries.llm.scratch import stored
from tests.llm.rows import LONG, ROWS, documents, nothing


class Sets:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i: i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest id per component of fingerprints with at most four differing bits."""
    sets, codes = Sets(), sorted(set(prints.values()))
    array = np.array(codes, np.uint64)
    for i, c in enumerate(codes):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1:] ^ np.uint64(c)) <= 4):
            sets.join(c, codes[i + 1 + int(j)])
    least = {}
    for i, c in prints.items():
        least[sets.root(c)] = min(least.get(sets.root(c), i), i)
    return {i: least[sets.root(c)] for i, c in prints.items()}


def test_simhash_query_against_plain_version(spark, small):
    got = queries.op7_simhash(spark, small).toPandas()
    docs = pd.read_parquet(f"{small}/documents.parquet")
    prints = {i: plain_fingerprint(t) for i, t in zip(docs["doc_id"], docs["text"], strict=True)}
    assert {i: int(f, 16) for i, f in zip(got["doc_id"], got["fingerprint"], strict=True)} == prints
    assert dict(zip(got["doc_id"], got["component_id"], strict=True)) == plain_groups(prints)
    assert got["fingerprint"].str.fullmatch("[0-9a-f]{16}").all()


def test_all_links_of_near_codes_are_found(spark):
    random.seed(3)
    prints = {}
    for c in range(25):
        code = random.getrandbits(64)
        for k in range(20):
            prints[c * 100 + k] = code
            code ^= sum(1 << b for b in random.sample(range(64), random.choice([1, 2, 3, 4, 5, 6])))
    rows = [(i, c - (1 << 64) if c >> 63 else c) for i, c in prints.items()]
    frame = stored(spark.createDataFrame(rows, "doc_id long, fingerprint long"))
    got = {r["doc_id"]: r["component_id"] for r in simhash.groups(frame).collect()}
    assert got == plain_groups(prints)


def test_a_large_group_makes_few_links(spark):
    """Thousands of codes around one center: links grow with the codes, not with their pairs."""
    random.seed(4)
    codes = {0} | {sum(1 << b for b in random.sample(range(60), 2)) for _ in range(3000)}
    frame = stored(spark.createDataFrame([(0, c, c) for c in codes], "family int, code long, node long"))
    links = simhash.ball_pairs(frame, len(codes))
    assert links.count() < 100 * len(codes)
    assert components(links).filter("root = 0").count() == len(codes) - 1


@pytest.mark.parametrize("half", [1, 2])
@pytest.mark.parametrize("power", [8, 11, 15])
def test_a_code_goes_to_few_buckets_however_many_there_are(power, half):
    """Before, radius 2 took a code to all of 256 buckets and to 1,323 of 2,048."""
    flips = simhash.masks(64, half)
    kinds = np.unique(simhash.parities(flips, power))
    assert len(kinds) == sum(math.comb(power, k) for k in range(half + 1))
    codes = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    assert np.array_equal(simhash.parities(codes ^ flips[-1], power), simhash.parities(codes, power) ^ simhash.parities(flips[-1:], power))
    assert np.bincount(simhash.parities(codes, 8), minlength=256).max() < 60


def test_crowded_buckets_are_done_in_passes(spark, monkeypatch):
    """A clump of codes fills its buckets far beyond their mean size; what is found is the same."""
    rng, center = random.Random(5), random.Random(6).getrandbits(64)
    codes = {center ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 9))) for _ in range(400)}
    prints = dict(enumerate(sorted(codes)))
    frame = stored(spark.createDataFrame([(i, c - (1 << 64) if c >> 63 else c) for i, c in prints.items()],
                                         "doc_id long, fingerprint long"))
    monkeypatch.setattr(simhash, "BUCKET_ENTRIES", 300)
    got = {r["doc_id"]: r["component_id"] for r in simhash.groups(frame).collect()}
    assert got == plain_groups(prints) and len(set(got.values())) > 1


def test_simhash_of_awkward_rows(spark):
    docs = documents(spark)
    prints = stored(simhash.fingerprints(docs))
    got = simhash.groups(prints).collect()
    assert len(got) == len(ROWS)
    zero = [r for r in got if r["fingerprint"] == 0]
    assert {r["doc_id"] for r in zero} == {1, 2, 3} and {r["component_id"] for r in zero} == {1}
    assert {r["component_id"] for r in got if r["doc_id"] in (5, 6)} == {5}
    assert sum(r["doc_id"] is None for r in got) == 1
    assert simhash.groups(stored(simhash.fingerprints(nothing(spark)))).count() == 0


def test_long_texts_are_hashed_whole():
    words = LONG.split()
    assert simhash.simhash(simhash.shingle_hashes(LONG, 4)) == np.uint64(plain_fingerprint(LONG))
    assert len(simhash.shingle_hashes(LONG, 5)) == len(words) - 4


def test_near_dedup_of_awkward_rows(spark):
    docs = documents(spark)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # Texts without words are one group; 7 is 5 with one more line: 236 of 243 shingles.
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 8, 9] and ids.count(None) == 1
    assert simhash.near_dedup(nothing(spark)).count() == 0


def test_near_groups_against_plain_similarity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    raw = docs.toPandas()
    got = simhash.near_groups(docs).toPandas()
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in raw["text"]]
    at, pairs = collections.defaultdict(list), set()
    for i, s in enumerate(sets):
        for h in s:
            at[h].append(i)
    for members in at.values():
        pairs.update((members[0], m) for m in members[1:])
        pairs.update(zip(members, members[1:], strict=False))
    wanted, joined = [], Sets()
    ids = raw["doc_id"].astype(str).tolist()
    for a, b in pairs:
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            wanted.append((ids[a], ids[b]))
            joined.join(ids[a], ids[b])
    group = dict(zip(got["doc_id"], got["first_id"], strict=True))
    assert len(wanted) > 50
    assert sum(group[a] == group[b] for a, b in wanted) / len(wanted) >= 0.9
    for i in ids:  # nothing is joined that plain similarity keeps apart, but near the limit by a hair
        if group[i] != i:
            assert joined.root(i) == joined.root(group[i])


def grouped(spark, texts):
    docs = documents(spark, [(i, t, "s") for i, t in enumerate(texts)], extra=False)
    return {int(r["doc_id"]): int(r["first_id"]) for r in simhash.near_groups(docs).collect()}


def similarity(a, b):
    a, b = (set(simhash.shingle_hashes(t, 5).tolist()) for t in (a, b))
    return len(a & b) / len(a | b)


def test_a_repeated_phrase_makes_no_near_duplicates(spark):
    texts = [" ".join(f"five words that both repeat {' '.join(f'{name}{k}x{i}' for i in range(4))}" for k in range(400))
             for name in "ab"]
    assert similarity(*texts) < 0.001
    assert grouped(spark, texts) == {0: 0, 1: 1}


def test_repeats_do_not_hide_near_duplicates(spark):
    body, refrain = item(400, "w"), item(30, "r")
    texts = [f"{body} {refrain}", f"{body} " + f"{refrain} " * 60]
    assert similarity(*texts) >= 0.95
    assert grouped(spark, texts) == {0: 0, 1: 0}


def test_pairs_within_a_large_group_of_near_copies_are_found(spark):
    """Thousands of texts of one template, all a little too far apart (0.69), and pairs among them that are near enough."""
    random.seed(5)
    template, planted = item(204, "t"), random.sample(range(2000), 100)
    texts = [f"{template} {item(45, f'own{i}x')}" for i in range(2000)]
    for a in planted:
        texts.append(" ".join([*texts[a].split()[:-24], *(f"new{a}x{i}" for i in range(24))]))
    assert 0.68 < similarity(texts[0], texts[1]) < 0.7 and 0.81 < similarity(texts[planted[0]], texts[2000]) < 0.83
    assert grouped(spark, texts) == {i: i for i in range(2000)} | {2000 + k: a for k, a in enumerate(planted)}


def test_large_meetings_are_linked_by_ball_hashing(spark):
    """Codes one bit from a center: all meet there, far more than give all their pairs."""
    rows = [(0, 0x5A5A5A5A ^ 1 << i % 32, i) for i in range(200)]
    met = simhash.ball_pairs(spark.createDataFrame(rows, "family int, code long, node long"), 200, 32, 1,
                             crowd=simhash.CROWD, least_parts=1)
    found = [(r["a"], r["b"]) for r in met.collect()]
    sets = Sets()
    for a, b in found:
        sets.join(a, b)
    assert {sets.root(i) for i in range(200)} == {0} and len(found) < 2 * 200
    assert sum(a == b for a, b in found) == 200


def test_near_copies_of_a_large_meeting_need_no_prefix_filter(spark, monkeypatch):
    """The rest that the prefix filter compares is left out here: the links of ball hashing alone make the group."""
    prefixes = simhash._prefixes
    monkeypatch.setattr(simhash, "_prefixes", lambda sets, similarity: prefixes(sets, similarity).limit(0))
    words = item(4000, "t").split()
    texts = [" ".join([*words[:k], f"own{k}", *words[k + 1:]]) for k in range(0, 600, 10)]
    assert similarity(texts[0], texts[30]) > 0.99
    assert grouped(spark, texts) == dict.fromkeys(range(60), 0)


def test_plan_grows_with_the_table():
    small, large = simhash.plan(1000), simhash.plan(10**9)
    assert small.bits == 32 and large.bits == 44 and large.families > small.families
    assert small.limits[0] < small.size * small.apart < small.limits[1]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    random.seed(seed)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1040)]
    edges += [(2000, 2000 + i) for i in range(1, 80)] + [(5, 5), (None, 3)]
    sets = Sets()
    for a, b in edges:
        if a is not None:
            sets.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: sets.root(x) for x in sets.parent if sets.root(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def item(n, name="q"):
    return " ".join(f"{name}{i}" for i in range(n))


def test_items_are_found_at_the_threshold(spark):
    rows = [(i, item(n), "s") for i, n in ((1, 14), (2, 50))]
    items = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(3, "one two"), (4, ""), (5, None), (3, "one two"),
                                                                  (6, item(5, "z"))], "item_id long, text string")
    words = item(50).split()
    docs = documents(spark, [
        (10, LONG + " " + item(50).upper().replace(" ", " , ") + " " + LONG, "s"),
        (11, " ".join(words[:41]), "s"),   # 37 of 46 shingles: more than 0.8; and all 10 of item 1
        (12, " ".join(words[:40]), "s"),   # 36 of 46: less
        (13, " ".join([*words[:20], "gap", *words[20:]]), "s"),   # 42 of 46
        (14, "say One, TWO now", "s"), (15, "one or two", "s"), (None, item(5, "z"), "s")], extra=False)
    got = sorted((r["doc_id"] or 0, r["item_id"], r["n_shared"]) for r in decontaminate.contaminated(docs, items).collect())
    assert got == [(0, 6, 1), (10, 1, 10), (10, 2, 46), (11, 1, 10), (11, 2, 37), (12, 1, 10), (13, 1, 10), (13, 2, 42), (14, 3, 1)]
    assert [r["doc_id"] for r in decontaminate.decontaminate(docs, items).collect()] == [15]


def test_decontamination_of_awkward_rows(spark, small):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    docs = documents(spark)
    clean = decontaminate.decontaminate(docs, items)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert decontaminate.decontaminate(docs, nothing(spark, "item_id long, text string")).count() == len(ROWS)
    assert decontaminate.contaminated(nothing(spark), items).count() == 0
