"""URL filter: host and path rules first, then a weighted vocabulary counted by an Aho-Corasick automaton.

``judge`` adds ``host``, ``path``, ``rule``, ``verdict`` and the terms found. A rule's verdict stands; where no rule fits,
one strict term or ``soft_limit`` distinct soft terms block the url. A term counts only between characters other than
a-z and 0-9. Rows are judged one by one, so nothing is shuffled and repeated rows get equal verdicts.

A null url, or one without ``://``, has an empty host and path, so no rule fits it; a null url holds no terms and is
allowed. Very long urls are read whole. Rules of one length (only possible with equal text) decide by the first one given.
An empty table gives an empty result. Input columns that bear the name of a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridseries.llm.text import free_name

RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"),
         ("block", "net/fr/"))

# Terms that block a url alone, and terms that block it together.
STRICT = tuple("""
    porn porno pornos xxx xxxvideos hardcore hentai milf nude nudes nudity camgirl camgirls camsex escort escorts fetish
    casino casinos slots roulette blackjack sportsbook betting viagra cialis levitra xanax tramadol warez keygen
    keygens crackz torrentz payday phishing malware darkweb
""".split())
SOFT = tuple("""
    adult adults sex sexy cam cams dating hot girls amateur free win winner wins bonus bet bets poker lottery jackpot
    gamble gambling pills pill pharmacy pharma cheap discount loan loans credit crack cracked serial torrent torrents
    hack hacks hacked replica replicas weight diet miracle spins spin vip naked
""".split())
SOFT_LIMIT = 2

RESULT = {"host": "string", "path": "string", "rule": "string", "verdict": "string",
          "strict_terms": "array<string>", "soft_terms": "array<string>"}


def automaton(strict: tuple[str, ...], soft: tuple[str, ...]):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for kind, terms in (("soft", soft), ("strict", strict)):
        for term in terms:
            machine.add_word(term, (kind, term))
    if len(machine):
        machine.make_automaton()
    return machine


def terms_in(machine, text: str) -> tuple[list[str], list[str]]:
    """Distinct strict and soft terms of a lower-case text, each between word boundaries."""
    found = {"strict": set(), "soft": set()}
    if not len(machine):
        return [], []
    for end, (kind, term) in machine.iter(text):
        begin = end - len(term)
        before, after = text[begin] if begin >= 0 else "", text[end + 1: end + 2]
        if not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum()):
            found[kind].add(term)
    return sorted(found["strict"]), sorted(found["soft"])


def by_host(rules) -> dict[str, list[tuple[str, str, str]]]:
    """Rules by host: (path, verdict, rule), the longest path first."""
    table: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        table.setdefault(host, []).append((slash + path, verdict, rule))
    return {host: sorted(found, key=lambda x: -len(x[0])) for host, found in table.items()}


def rule_for(table, host: str, path: str) -> tuple[str, str] | None:
    """The longest rule that fits, with its verdict. A host fits the rules of every suffix that begins at a label."""
    best = None
    labels = host.split(".")
    for k in range(len(labels)):
        for begin, verdict, rule in table.get(".".join(labels[k:]), ()):
            if path.startswith(begin) and (best is None or len(rule) > len(best[1])):
                best = verdict, rule
    return best


def judge(pages: DataFrame, url: str = "url", rules=RULES, strict: tuple[str, ...] = STRICT,
          soft: tuple[str, ...] = SOFT, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """The input with host, path, rule, verdict and terms."""
    address = free_name([*pages.columns, *RESULT], "address")
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in RESULT]
    source = pages.select(*kept, F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias(address))
    full = F.col(address)
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    capital = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    source = source.withColumns({
        "host": F.translate(F.regexp_extract(full, parts, 1), capital, capital.lower()),
        "path": F.regexp_extract(full, parts, 2),
        address: F.translate(full, capital, capital.lower())})
    table = by_host(rules)
    fields = [f for f in source.schema if f.name != address]
    added = T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in list(RESULT.items())[2:]))
    schema = T.StructType([*fields, *added])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = automaton(strict, soft)
        for batch in batches:
            out = []
            for link, host, path in zip(batch[address], batch["host"], batch["path"], strict=True):
                decided = rule_for(table, host, path)
                hard, mild = terms_in(machine, link)
                verdict = decided[0] if decided else "block" if hard or len(mild) >= soft_limit else "allow"
                out.append((decided[1] if decided else None, verdict, hard, mild))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield batch.drop(columns=address).assign(**dict(zip(list(RESULT)[2:], map(list, columns), strict=True)))

    return source.mapInPandas(run, schema)
