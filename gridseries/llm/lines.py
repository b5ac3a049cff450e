"""Line dedup by winnowing over line hashes.

The lines with a word are hashed. From every line a window reaches to the first line that makes ``min_words`` words
together. Winnowing keeps of each window only its least line hash: neighbouring windows mostly share it, so a text has far
fewer fingerprints than lines, and a run of at least ``min_words`` words that two texts share is sure to hold a window, so
a fingerprint, of both. Fingerprints that occur at one place only are done with; the windows of the others are joined on
fingerprint and content with the first place that has them, so a fingerprint common to many texts pairs nothing. Matches are
extended line by line both ways as long as both of two independent hashes of the lines agree, and the later run is deleted.

Documents are ordered by (id, text hash), nulls first, lines by their number. A line is only deleted if an equal one
comes earlier, so the first copy always stays. Within a text a later repeat of its own lines goes as well.

Null and empty texts have no lines and stay as they are (null becomes empty). Very long texts are handled whole.
Repeated rows (equal id and text) are one document: they do not delete each other's lines. An empty table gives an empty
result. Columns of the input that bear the name of an added column are replaced; all others go along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.scratch import stored
from gridseries.llm.text import WORD, free_name, let, whole

MIN_WORDS = 50


def _numbered(text: Column) -> Column:
    """Number, two hashes and words of each line that has a word."""
    every = F.transform(F.split(text, "\n"), lambda x, i: F.struct(
        i.alias("line"), F.xxhash64(x).alias("hash"), F.xxhash64(F.lit(1), x).alias("check"), F.size(F.regexp_extract_all(x, F.lit(WORD), F.lit(0))).alias("n")))
    return F.filter(every, lambda x: x["n"] > 0)


def _windows(lines: Column, min_words: int) -> Column:
    """From each line on the shortest run of ``min_words`` words: its least hash and where that is, first line, length, content.

    Each line has a word, so a window has at most ``min_words`` lines.
    """
    def at(x, i):
        ahead = F.slice(lines, i + 1, min_words)
        reach = F.aggregate(ahead, F.struct(F.lit(0).alias("words"), F.lit(0).alias("len")), lambda s, y: F.when(
            s["words"] >= min_words, s).otherwise(F.struct(
                (s["words"] + y["n"]).alias("words"), (s["len"] + 1).alias("len"))))
        return let(reach, lambda r: F.when(r["words"] >= min_words, let(F.transform(
            F.slice(lines, i + 1, r["len"]), lambda y: y["hash"]), lambda h: let(F.array_min(h), lambda m: F.struct(
                m.alias("least"), (i + F.array_position(h, m)).cast("int").alias("place"), i.alias("at"),
                r["len"].alias("len"), F.xxhash64(h).alias("content"))))))

    return F.filter(F.transform(lines, at), lambda w: w.isNotNull())


def _fingerprints(windows: Column) -> Column:
    """The distinct least hashes of a text: first and last place, and the windows that have it."""
    ordered = F.array_sort(windows)  # by least hash, so each fingerprint's windows stand together

    def runs(w):
        starts = F.filter(F.sequence(F.lit(0), F.size(w)), lambda i: (i == 0) | (i == F.size(w)) | (
            F.get(w, i)["least"] != F.get(w, i - 1)["least"]))
        return let(starts, lambda s: F.transform(F.slice(s, 1, F.size(s) - 1), lambda i, k: let(
            F.slice(w, i + 1, F.get(s, k + 1) - i), lambda own: F.struct(
                F.get(own, F.lit(0))["least"].alias("least"), F.get(own, F.lit(0))["place"].alias("low"),
                F.get(own, F.size(own) - 1)["place"].alias("high"),
                F.transform(own, lambda x: F.struct(x["at"].alias("at"), x["len"].alias("len"), x["content"].alias("content"))
                            ).alias("windows")))))

    return let(ordered, runs)


def _below(ordered: Column, x: Column) -> Column:
    """How many entries of an ascending array are less than x, by halving."""
    steps = F.array(*[F.lit(1 << k) for k in range(26, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(
        (n + step <= F.size(ordered)) & (F.get(ordered, n + step - 1) < x), n + step).otherwise(n))


def _spread(matches: Column, own: Column, other: Column, shift: Column) -> Column:
    """Places of ``own`` in the extended matches: windows (at, len) that equal ``other`` at at - shift."""
    def runs(differs):
        # differs: ascending places where the texts do not agree, with one before the start and one behind the end.
        around = F.transform(matches, lambda m: let(_below(differs, m["at"]), lambda n: F.struct(
            (F.get(differs, n - 1) + 1).alias("a"), F.get(differs, n).alias("b"), (m["at"] + m["len"]).alias("end"))))
        return F.array_distinct(F.transform(F.filter(around, lambda r: r["b"] >= r["end"]),
                                            lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"))))

    places = F.sequence(F.lit(-1), F.size(own))
    apart = F.filter(places, lambda x: (x < 0) | (x - shift < 0) | (x >= F.size(own)) | (x - shift >= F.size(other)) | ~(
        F.get(own, x).eqNullSafe(F.get(other, x - shift))))
    return F.flatten(F.transform(let(apart, runs), lambda r: F.sequence(r["a"], r["b"] - 1)))


def fingerprints(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """The lines of each document that has any, and its fingerprints with their windows."""
    content = whole(F.col(f"`{text}`"))
    lined = docs.select("doc_id", F.xxhash64(content).alias("text_hash"), _numbered(content).alias("lines"))
    lined = stored(lined.filter(F.size("lines") > 0))
    return lined, stored(lined.select("doc_id", "text_hash", F.inline(_fingerprints(_windows(F.col("lines"), min_words)))))


def repeats(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, removed): the numbers of the lines to delete, for documents that have any."""
    lined, prints = fingerprints(docs, text, min_words)
    low, high = F.struct("doc_id", "text_hash", F.col("low").alias("at")), F.struct("doc_id", "text_hash", F.col("high").alias("at"))
    common = prints.groupBy("least").agg(F.min(low).alias("low"), F.max(high).alias("high")).filter(
        ~F.col("low").eqNullSafe(F.col("high"))).select("least")
    windows = stored(prints.join(common, "least", "left_semi").select("doc_id", "text_hash", "least", F.inline("windows")))
    own = F.struct("doc_id", "text_hash", "at")
    first = windows.groupBy("least", "content").agg(F.min(own).alias("first"), F.max(own).alias("last")).filter(
        ~F.col("first").eqNullSafe(F.col("last"))).drop("last")
    matched = windows.join(first, ["least", "content"]).filter(~own.eqNullSafe(F.col("first"))).groupBy(
        "doc_id", "text_hash", F.col("first.doc_id").alias("from_id"), F.col("first.text_hash").alias("from_hash"),
        (F.col("at") - F.col("first.at")).alias("shift")).agg(F.collect_set(F.struct("at", "len")).alias("matches"))
    hashes = lined.select("doc_id", "text_hash", F.transform("lines", lambda x: F.struct(x["hash"], x["check"])).alias("own"),
                          F.transform("lines", lambda x: x["line"]).alias("numbers")).dropDuplicates(["doc_id", "text_hash"])
    with_own = matched.alias("m").join(hashes.alias("h"), _same(("m.doc_id", "h.doc_id"), ("m.text_hash", "h.text_hash"))).select(
        "m.*", "h.own", "h.numbers")
    both = with_own.alias("m").join(hashes.alias("h"), _same(("m.from_id", "h.doc_id"), ("m.from_hash", "h.text_hash"))).select(
        "m.*", F.col("h.own").alias("other"))
    spread = both.select("doc_id", "text_hash", let(
        _spread(F.col("matches"), F.col("own"), F.col("other"), F.col("shift")),
        lambda p: F.transform(p, lambda i: F.get(F.col("numbers"), i))).alias("lines"))
    return spread.groupBy("doc_id", "text_hash").agg(F.collect_list("lines").alias("lines")).select(
        "doc_id", "text_hash", F.array_sort(F.array_distinct(F.flatten("lines"))).alias("removed"))


def _same(*pairs: tuple[str, str]) -> Column:
    found = F.lit(True)
    for a, b in pairs:
        found = found & F.col(a).eqNullSafe(F.col(b))
    return found


def dedup(docs: DataFrame, text: str = "text", min_words: int = MIN_WORDS, removed: str = "removed_lines",
          cleaned: str = "text") -> DataFrame:
    """The input with the numbers of its deleted lines, and its text without them in ``cleaned``."""
    name, digest, lines = (free_name(docs.columns, n) for n in ("found_id", "found_hash", "found_lines"))
    found = stored(repeats(docs, text, min_words)).toDF(name, digest, lines)
    content = whole(F.col(f"`{text}`"))
    key = F.col("doc_id").eqNullSafe(F.col(name)) & (F.xxhash64(content) == F.col(digest))
    joined = docs.join(found.hint("merge"), key, "left")  # it grows with the documents: the same plan at every size
    gone = F.coalesce(F.col(lines), F.array().cast("array<int>"))
    parts = F.split(content, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), gone)
    left = F.when(F.size(gone) == 0, content).otherwise(let(parts, lambda p: F.array_join(F.transform(
        stay, lambda i: F.get(p, i)), "\n")))
    made = {removed.lower(): gone.alias(removed), cleaned.lower(): left.alias(cleaned)}
    out = [made.pop(c.lower(), F.col(f"`{c}`")) for c in docs.columns]
    return joined.select(*out, *made.values())
