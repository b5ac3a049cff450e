"""Quality rules: every rule is evaluated once into a bit, policies are masks over the stored bits.

``measure`` adds the measurements and the ledger (``failures``, one bit per rule). ``apply_policy`` and ``ablation``
only read the ledger, so a new policy version never reads a text again. All of it is DataFrame functions.

Null and empty texts have no words, fail the rule ``short`` and are rejected. Very long texts are measured whole.
Repeated rows and null ids are judged row by row. An empty table gives an empty result. Columns of the input that
bear the name of a measurement are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.text import WORD, free_name, let, whole, words

WINDOW = 8
DISTINCT_WINDOW = 4096


def _share_above(part: str, of: str, percent: int) -> Column:
    return F.col(part) * 100 > F.col(of) * percent


# In bit order: new rules go to the end, so that stored ledgers keep their meaning.
RULES = {
    "short": lambda: F.col("n_words") < 20,
    "repeated_words": lambda: _share_above("n_repeat_words", "n_words", 30),
    "symbols": lambda: _share_above("n_symbols", "n_words", 10),
    "few_letters": lambda: F.col("n_letter_words") * 100 < F.col("n_words") * 60,
    "shouting": lambda: _share_above("n_upper_words", "n_words", 50),
    "exclamations": lambda: _share_above("n_exclamations", "n_words", 30),
    "few_distinct": lambda: F.col("n_distinct_words") * 100 < F.col("n_words") * 15,
    "duplicate_lines": lambda: _share_above("n_dup_lines", "n_lines", 50),
    "word_length": lambda: (F.col("word_chars") < F.col("n_words") * 2) | (F.col("word_chars") > F.col("n_words") * 20),
    "ellipsis_lines": lambda: _share_above("n_ellipsis_lines", "n_lines", 30),
    "bullet_lines": lambda: _share_above("n_bullet_lines", "n_lines", 90),
    "few_distinct_near": lambda: F.col("n_window_distinct") * 100 < F.col("n_window_words") * 15,
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BITS["short"] | BITS["repeated_words"]


@dataclass(frozen=True)
class Policy:
    """A text goes if it fails a rule of ``hard``, or at least ``soft_limit`` rules of ``soft``."""

    version: str
    hard: tuple[str, ...]
    soft: tuple[str, ...]
    soft_limit: int

    @property
    def hard_mask(self) -> int:
        return sum(BITS[r] for r in self.hard)

    @property
    def soft_mask(self) -> int:
        return sum(BITS[r] for r in self.soft)


POLICIES = {p.version: p for p in (
    Policy("base", ("short", "repeated_words"), (), 1),
    Policy("v1", ("short", "repeated_words", "symbols", "few_letters", "shouting", "exclamations", "few_distinct"),
           ("duplicate_lines", "word_length", "ellipsis_lines", "bullet_lines"), 2),
    # The share of distinct words falls with length alone, so v2 takes it in windows of equal length.
    Policy("v2", ("short", "repeated_words", "symbols", "few_letters", "shouting", "exclamations", "few_distinct_near"),
           ("duplicate_lines", "word_length", "ellipsis_lines", "bullet_lines"), 2),
)}
PRODUCTION = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
            "n_upper_words", "n_exclamations", "n_distinct_words", "n_ellipsis_lines", "n_bullet_lines",
            "n_window_distinct", "n_window_words")


def distinct_near(w: Column) -> Column:
    """Distinct words summed over windows of equal length that hold the whole text, the last one up to its end."""
    size = F.size(w)
    starts = F.transform(F.sequence(F.lit(0), F.floor((size - 1) / DISTINCT_WINDOW).cast("int")),
                         lambda k: F.least(k * DISTINCT_WINDOW, size - DISTINCT_WINDOW))
    sums = F.aggregate(starts, F.lit(0), lambda n, i: n + F.size(F.array_distinct(F.slice(w, i + 1, DISTINCT_WINDOW))))
    return F.when(size <= DISTINCT_WINDOW, F.size(F.array_distinct(w))).otherwise(sums)


def near_words(w: Column) -> Column:
    """Words in those windows, counted as often as they are in one."""
    return F.when(F.size(w) <= DISTINCT_WINDOW, F.size(w)).otherwise(
        F.ceil(F.size(w) / DISTINCT_WINDOW).cast("int") * DISTINCT_WINDOW)


def _covered(starts: Column) -> Column:
    """Words under windows that begin at the given ascending places."""
    def step(total, place):
        return F.struct(
            (total["n"] + F.least(F.lit(WINDOW), place - total["last"])).alias("n"), place.alias("last"))

    first = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(starts, first, step, lambda total: total["n"])


def repeat_words(of: Column) -> Column:
    """Words in windows of eight words that the text holds twice or more. Windows are compared by 64-bit hash."""
    def marked(hashes):
        places = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))

        def known(x):
            return F.coalesce(x, F.lit(False))

        def neighbours(s):
            return F.filter(s, lambda x, k: known(x["h"] == F.get(s, k - 1)["h"]) | known(x["h"] == F.get(s, k + 1)["h"]))

        return _covered(F.array_sort(F.transform(let(F.array_sort(places), neighbours), lambda x: x["i"])))

    def windows(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW),
                           lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]))

    def count(w):
        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(
            let(windows(w), lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(marked(h))))

    return let(of, count)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input with the measurements and the ledger ``failures``."""
    content = whole(F.col(f"`{text}`"))
    lines = F.filter(F.split(content, "\n"), lambda x: x.rlike(WORD))

    def numbers(w):
        return F.struct(
            F.size(w).alias("n_words"),
            F.length(F.array_join(w, "")).alias("word_chars"),
            repeat_words(w).alias("n_repeat_words"),
            F.size(F.array_distinct(w)).alias("n_distinct_words"),
            distinct_near(w).alias("n_window_distinct"),
            near_words(w).alias("n_window_words"),
            F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))).alias("n_letter_words"),
            F.size(F.filter(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x))).alias("n_upper_words"))

    def line_numbers(x):
        return F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
            F.size(F.filter(x, lambda s: s.rlike("(\\.\\.\\.|…)\\s*$"))).alias("n_ellipsis_lines"),
            F.size(F.filter(x, lambda s: s.rlike("^\\s*[-*•‣●]"))).alias("n_bullet_lines"))

    found = F.struct(
        let(words(F.col(f"`{text}`")), numbers).alias("w"),
        let(lines, line_numbers).alias("l"),
        (F.length(content) - F.length(F.regexp_replace(content, r"[#*$%&|<>]", ""))).alias("n_symbols"),
        (F.length(content) - F.length(F.replace(content, F.lit("!"), F.lit("")))).alias("n_exclamations"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {*MEASURES, "failures"}]
    made = free_name(docs.columns, "found")
    measured = docs.select(*kept, F.explode(F.array(found)).alias(made))
    inside = {**dict.fromkeys(("n_words", "word_chars", "n_repeat_words", "n_distinct_words", "n_letter_words",
                               "n_upper_words", "n_window_distinct", "n_window_words"), "w."),
              **dict.fromkeys(("n_lines", "n_dup_lines", "n_ellipsis_lines", "n_bullet_lines"), "l.")}
    measured = measured.select(*kept, *[F.col(f"{made}.{inside.get(m, '')}{m}").cast("long").alias(m) for m in MEASURES])
    bits = [F.when(rule(), F.lit(BITS[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    ledger = bits[0]
    for bit in bits[1:]:
        ledger = ledger.bitwiseOR(bit)
    return measured.withColumn("failures", ledger.cast("long"))


def passes(policy: Policy, failures: Column) -> Column:
    soft = F.bit_count(failures.bitwiseAND(F.lit(policy.soft_mask)))
    return (failures.bitwiseAND(F.lit(policy.hard_mask)) == 0) & (soft < policy.soft_limit)


def apply_policy(ledger: DataFrame, version: str = PRODUCTION, verdict: str = "kept") -> DataFrame:
    """The ledger with the verdict of one policy."""
    return ledger.withColumn(verdict, passes(POLICIES[version], F.col("failures")))


def ablation(ledger: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """Per rule of a policy: rows that fail it, and rows that would stay if the rule were dropped.

    One aggregate over the bits, without reading a text.
    """
    policy = POLICIES[version]
    rejected = ~passes(policy, F.col("failures"))
    used = [*policy.hard, *policy.soft]
    sums = []
    for rule in used:
        without = F.col("failures").bitwiseAND(F.lit(~BITS[rule]))
        sums += [F.count(F.when(F.col("failures").bitwiseAND(F.lit(BITS[rule])) != 0, 1)).alias(f"{rule}_fails"),
                 F.count(F.when(rejected & passes(policy, without), 1)).alias(f"{rule}_alone")]
    totals = ledger.agg(*sums, F.count(F.lit(1)).alias("n_rows"), F.count(F.when(rejected, 1)).alias("n_rejected"))
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit"),
                              F.col(f"{r}_fails").alias("n_fails"), F.col(f"{r}_alone").alias("n_decided_alone"))
                     for r in used])
    return totals.select(F.lit(version).alias("policy"), "n_rows", "n_rejected", F.explode(rows).alias("r")).select(
        "policy", "n_rows", "n_rejected", "r.*")
