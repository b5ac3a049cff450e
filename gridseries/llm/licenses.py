"""License scan by ordered signature rules.

A text is reduced to its lower-case words with one space between them. Rules are regular expressions over that line, each
behind a gate of keywords: a rule runs only on texts that hold all words of one of its gates, and every match of its pattern
holds such words. Of overlapping detections, one whose words
lie within those of another goes if the other has a higher priority, or the same and more words (or the same words and
comes first in the table). ``scan`` adds the line's word count, the base phrases' places and the detections that are left.

Null and empty texts have no words and no detections. Very long texts are scanned whole. Rows are scanned one by one:
repeated rows get equal results and null ids are as good as others. An empty table gives an empty result. Input columns
that bear the name of a result column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridseries.llm.text import TERM, free_name, let, lower_ascii, whole, words

BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
RESULT = ("n_words", "base_places", "detections")

# Priorities, in steps: a tag made for machines, an address, a statement of grant, a bare name.
TAG, ADDRESS, GRANT, NAME = 95, 90, 80, 50

#: label; keywords that all must occur, "|" between alternatives; the name as a pattern over lower-case words; its tag; its address, if it has one.
#: "v" stands for an optional word before a number.
LICENSES = (
    ("0bsd", "zero clause bsd|0bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)(?: licen[cs]e)?", "0bsd", ""),
    ("afl-3.0", "academic", r"academic free licen[cs]e v(?: 3 0)?", r"afl 3 0", "opensource org licenses afl 3 0"),
    ("agpl-1.0", "affero", r"affero general public licen[cs]e v1(?: 0)?", "agpl 1 0", ""),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e(?: v3)?(?: 0)?", "agpl 3 0", "gnu org licenses agpl"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e v1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[cs]e(?: v2(?: 0)?)?", "apache 2 0",
     "apache org licenses license 2 0"),
    ("apsl-2.0", "apple", r"apple public source licen[cs]e(?: v2 0)?", "apsl 2 0", "opensource apple com"),
    ("artistic-1.0", "artistic", r"artistic licen[cs]e v1 0", "artistic 1 0", ""),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: v2 0)?", "artistic 2 0", "perlfoundation org artistic"),
    ("beerware", "beer ware|beerware", r"beer ?ware licen[cs]e", "beerware", ""),
    ("blueoak-1.0.0", "oak", r"blue oak model licen[cs]e(?: 1 0 0)?", "blueoak 1 0 0", "blueoakcouncil org license"),
    ("bsd-2-clause", "bsd|freebsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)(?: licen[cs]e)?", "bsd 2 clause",
     "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: licen[cs]e)?",
     "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[cs]e)?", "bsd 4 clause", ""),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e", "bsd", "opensource org licenses bsd license"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?: v1 0)?", "bsl 1 0", "boost org license"),
    ("busl-1.1", "business", r"business source licen[cs]e(?: v?1 1)?", "busl 1 1", "mariadb com bsl"),
    ("cc0-1.0", "cc0", r"cc0(?: v?1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero"),
    ("cc-by-nc-nd", "by nc nd", r"(?:cc|creative commons) by nc nd(?: \d \d)?", r"cc by nc nd \d \d",
     "creativecommons org licenses by nc nd"),
    ("cc-by-nc-sa", "by nc sa", r"(?:cc|creative commons) by nc sa(?: \d \d)?", r"cc by nc sa \d \d",
     "creativecommons org licenses by nc sa"),
    ("cc-by-nc", "by nc", r"(?:cc|creative commons) by nc(?: \d \d)?", r"cc by nc \d \d",
     "creativecommons org licenses by nc"),
    ("cc-by-nd", "by nd", r"(?:cc|creative commons) by nd(?: \d \d)?", r"cc by nd \d \d",
     "creativecommons org licenses by nd"),
    ("cc-by-sa", "by sa", r"(?:cc|creative commons) by sa(?: \d \d)?", r"cc by sa \d \d",
     "creativecommons org licenses by sa"),
    ("cc-by-name", "creative commons attribution",
     r"creative commons attribution(?: \d \d)?(?: (?:international|unported|generic))?(?: licen[cs]e)?", r"cc by \d \d",
     "creativecommons org licenses by"),
    ("cddl-1.0", "common development", r"common development and distribution licen[cs]e(?: v1 0)?", "cddl 1 0",
     "opensource org licenses cddl"),
    ("cecill-2.1", "cecill", r"cecill(?: free software)?(?: licen[cs]e| license agreement)?(?: v2 1)?", "cecill 2 1",
     "cecill info"),
    ("clear-bsd", "clear bsd", r"clear bsd licen[cs]e", "bsd 3 clause clear", ""),
    ("cpal-1.0", "attribution common", r"common public attribution licen[cs]e(?: v1 0)?", "cpal 1 0", ""),
    ("cpl-1.0", "common", r"common public licen[cs]e(?: v1 0)?", "cpl 1 0", "ibm com developerworks library os cpl"),
    ("ecl-2.0", "educational", r"educational community licen[cs]e(?: v2 0)?", "ecl 2 0", "opensource org licenses ecl"),
    ("efl-2.0", "eiffel", r"eiffel forum licen[cs]e(?: v2)?", "efl 2 0", ""),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e(?: v?2 0)?", "elastic 2 0", "elastic co licensing elastic license"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e v1 0", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: v2(?: 0)?)?", "epl 2 0", "eclipse org legal epl 2 0"),
    ("etalab-2.0", "etalab", r"(?:licence ouverte )?etalab(?: open licen[cs]e)?(?: 2 0)?", "etalab 2 0", "etalab gouv fr"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?: v1 [12])?", r"eupl 1 [12]", "joinup ec europa eu"),
    ("gfdl-1.3", "documentation", r"(?:gnu )?free documentation licen[cs]e(?: v1 [123])?", r"gfdl 1 [123]",
     "gnu org licenses fdl"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[cs]e v1(?: 0)?", "gpl 1 0", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[cs]e v2(?: 0)?", "gpl 2 0",
     "gnu org licenses old licenses gpl 2 0"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[cs]e v3(?: 0)?", "gpl 3 0", "gnu org licenses gpl 3 0"),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e(?: v\d+(?: \d+)?)?", r"gpl(?: \d+ \d+)?",
     "gnu org licenses gpl"),
    ("hpnd", "historical", r"historical permission notice and disclaimer", "hpnd", ""),
    ("icu", "icu", r"icu licen[cs]e", "icu", ""),
    ("ijg", "jpeg", r"independent jpeg group s software", "ijg", ""),
    ("ipl-1.0", "ibm", r"ibm public licen[cs]e(?: v1 0)?", "ipl 1 0", ""),
    ("isc", "isc", r"isc licen[cs]e", "isc", "opensource org licenses isc"),
    ("json", "json", r"json licen[cs]e", "json", "json org license"),
    ("lgpl-2.0", "library general", r"(?:gnu )?library general public licen[cs]e(?: v2(?: 0)?)?", "lgpl 2 0", ""),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public licen[cs]e v2 1", "lgpl 2 1",
     "gnu org licenses old licenses lgpl 2 1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public licen[cs]e(?: v3)?(?: 0)?", "lgpl 3 0", "gnu org licenses lgpl"),
    ("libpng", "libpng", r"libpng licen[cs]e(?: v2)?", r"libpng(?: 2 0)?", ""),
    ("llama", "llama", r"(?:meta )?llama (?:\d )?community licen[cs]e(?: agreement)?", r"llama\d?", "llama com license"),
    ("lppl-1.3c", "latex", r"latex project public licen[cs]e(?: v1 3c?)?", "lppl 1 3c", "latex project org lppl"),
    ("mit", "mit", r"mit licen[cs]e", "mit", "opensource org licenses mit"),
    ("mit-0", "mit", r"mit no attribution(?: licen[cs]e)?", "mit 0", ""),
    ("mit-x11", "x11", r"(?:mit )?x11 licen[cs]e", "x11", ""),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e v1 [01]", r"mpl 1 [01]", "mozilla org mpl mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: v2(?: 0)?)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", "ms rl", "opensource org licenses ms rl"),
    ("mulanpsl-2.0", "mulan", r"mulan (?:psl|permissive software licen[cs]e)(?: v2)?", "mulanpsl 2 0",
     "license coscl org cn mulanpsl2"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa (?:open source )?licen[cs]e", "ncsa", ""),
    ("nvidia", "nvidia", r"nvidia (?:open model|source code|software) licen[cs]e(?: agreement)?", "nvidia", ""),
    ("odbl-1.0", "database", r"open (?:data commons open )?database licen[cs]e(?: v1 0)?", "odbl 1 0",
     "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "commons", r"open data commons attribution licen[cs]e(?: v1 0)?", "odc by 1 0",
     "opendatacommons org licenses by"),
    ("ofl-1.1", "font", r"(?:sil )?open font licen[cs]e(?: v?1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("ogl-3.0", "government", r"open government licen[cs]e(?: v\d 0)?", r"ogl uk \d 0",
     "nationalarchives gov uk doc open government licence"),
    ("openrail-m", "open rail|openrail", r"(?:creativeml |bigscience |bigcode )?open ?rail (?:m )?(?:licen[cs]e)?", "openrail", ""),
    ("openssl", "openssl", r"openssl licen[cs]e", "openssl", "openssl org source license"),
    ("osl-3.0", "open software", r"open software licen[cs]e(?: v3 0)?", "osl 3 0", "opensource org licenses osl 3 0"),
    ("pddl-1.0", "dedication", r"(?:open data commons )?public domain dedication and licen[cs]e(?: v1 0)?", "pddl 1 0",
     "opendatacommons org licenses pddl"),
    ("php-3.01", "php", r"php licen[cs]e(?: v3 01)?", "php 3 01", "php net license"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", "postgresql", "opensource org licenses postgresql"),
    ("psf-2.0", "python|psf", r"(?:python software foundation|psf) licen[cs]e(?: agreement)?(?: v2)?", "psf 2 0",
     "python org license"),
    ("qpl-1.0", "q public", r"q public licen[cs]e(?: v1 0)?", "qpl 1 0", ""),
    ("ruby", "ruby", r"ruby(?: s)? licen[cs]e", "ruby", ""),
    ("sleepycat", "sleepycat", r"sleepycat(?: software)? licen[cs]e", "sleepycat", ""),
    ("sspl-1.0", "server", r"server side public licen[cs]e(?: v1)?", "sspl 1 0", "mongodb com licensing server side"),
    ("unicode", "unicode", r"unicode(?: data files and software)? licen[cs]e(?: v3)?", "unicode 3 0",
     "unicode org license"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense", "unlicense org"),
    ("upl-1.0", "universal", r"universal permissive licen[cs]e(?: v1 0)?", "upl 1 0", ""),
    ("vim", "vim", r"vim licen[cs]e", "vim", ""),
    ("w3c", "w3c", r"w3c (?:software )?(?:notice and )?licen[cs]e", "w3c", "w3 org consortium legal"),
    ("wtfpl", "wtfpl|fuck", r"(?:do what the fuck you want to public licen[cs]e|wtfpl)", "wtfpl", "wtfpl net"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", "zlib", "opensource org licenses zlib"),
    ("zpl-2.1", "zope", r"zope public licen[cs]e(?: v2 1)?", "zpl 2 1", "zope org resources zpl"),
)

#: Statements that name no license: label, keywords, pattern, priority.
STATEMENTS = (
    ("reserved", "all rights reserved", r"all rights reserved", NAME),
    ("copyright", "copyright", r"(?:c )?copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)*", NAME),
    ("proprietary", "proprietary", r"(?:confidential and proprietary|proprietary and confidential)", GRANT),
    ("proprietary", "without written consent|without written permission",
     r"without (?:the )?(?:prior |express )+written (?:consent|permission)", GRANT),
    ("proprietary", "unauthorized", r"unauthorized (?:copying|use|reproduction|distribution)(?: \w+){0,6} prohibited", GRANT),
    ("no-redistribution", "not reproduced|not redistributed|not republished",
     r"may not be (?:reproduced|redistributed|republished)(?: or \w+)*", GRANT),
    ("public-domain", "domain", r"(?:released|placed|dedicated|is) (?:into|in|to) the public domain", GRANT),
    ("non-commercial", "noncommercial|non commercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?", NAME),
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy", TAG),
    ("isc", "permission modify distribute", r"permission to use copy modify and or distribute this software for any purpose", TAG),
    ("bsd", "binary", r"redistribution and use in source and binary forms with or without modification", TAG),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the licen[cs]e", TAG),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public", TAG),
    ("bsl-1.0", "boost", r"boost software licen[cs]e version 1 0 august 17th 2003", TAG),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", TAG),
    ("zlib", "express", r"provided as is without any express or implied warranty", GRANT),
)

_GRANTED = (r"(?:licen[cs]ed|released|distributed|available|published|provided|covered|governed|redistributed|shared) "
            r"(?:\w+ ){0,2}(?:under|by|with|as) (?:the )?(?:terms of )?(?:the |a |an )?")


DETECTIONS = "array<struct<first:bigint,last:bigint,priority:int,rule:int,label:string,words:string>>"
FIRST, LAST = "\x01", "\x02"  # marks that no word holds
BLOCK = 256


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[str, ...]
    pattern: str
    priority: int
    alternatives: tuple[tuple[str, ...], ...] = ()

    @property
    def gates(self) -> tuple[tuple[str, ...], ...]:
        """Sets of words, one of which must occur as a whole."""
        return self.alternatives or (self.keywords,)


def _gated(label: str, keywords: str, pattern: str, priority: int) -> Rule:
    """A rule with the words that all its alternatives of keywords have in common, and the alternatives."""
    gates = tuple(tuple(x.split()) for x in keywords.split("|"))
    return Rule(label, tuple(k for k in gates[0] if all(k in g for g in gates)), pattern, priority, gates)


def _worded(pattern: str) -> str:
    """'v3' in a name also stands for 'version 3' and 'v 3'; a bare 'v' is left out."""
    import re

    pattern = re.sub(r" v(?=\(| |$)", "", pattern)
    return re.sub(r"(?<= )v(\??)(?=\d|\\d|\[)", r"(?:v(?:ersion)? ?)?", pattern)


def rules() -> list[Rule]:
    """The ordered table: per license a tag, an address, a grant and a bare name, then the statements."""
    found = []
    for label, keywords, name, tag, address in LICENSES:
        name = _worded(name)
        found.append(Rule(label, ("spdx", "identifier"), rf"spdx licen[cs]e identifier (?:\w+ )?{tag}(?: or later| only)?", TAG))
        if address:
            found.append(Rule(label, tuple(address.split()[:2]), address, ADDRESS))
        found.append(_gated(label, keywords, _GRANTED + name, GRANT))
        found.append(_gated(label, keywords, name, NAME))
    found += [_gated(label, keywords, pattern, priority) for label, keywords, pattern, priority in STATEMENTS]
    return found


def places(terms: Column, line: Column, phrase: str) -> Column:
    """Word numbers at which a phrase stands, as an array."""
    parts = phrase.split()

    def at(w):
        def here(i):
            same = F.get(w, i) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                same = same & (F.get(w, i + k) == part)
            return same

        return F.filter(F.sequence(F.lit(0), F.size(w) - len(parts)), here)

    return F.when(F.contains(line, F.lit(f" {phrase} ")), at(terms)).otherwise(F.array().cast("array<int>"))


def _hits(line: Column, rule: Column) -> Column:
    """Detections of one rule: its words from and to, numbered from 0."""
    pattern = F.concat(F.lit(r"(?<= )(?:"), rule["pattern"], F.lit(r")(?= )"))

    def spans(hits):
        # The k-th match begins at the k-th word with the first mark and ends at the k-th with the last one.
        marked = F.split(F.regexp_replace(line, pattern, F.lit(f"{FIRST}$0{LAST}")), " ")

        def at(w, is_end):
            return F.filter(F.transform(w, lambda x, i: F.when(is_end(x), i - 1)), lambda i: i.isNotNull())

        return let(marked, lambda w: let(F.struct(
            at(w, lambda x: F.startswith(x, F.lit(FIRST))).alias("a"), at(w, lambda x: F.endswith(x, F.lit(LAST))).alias("b")),
            lambda ends: F.transform(hits, lambda text, k: F.struct(
                F.get(ends["a"], k).cast("long").alias("first"), F.get(ends["b"], k).cast("long").alias("last"),
                rule["priority"].alias("priority"), rule["no"].alias("rule"), rule["label"].alias("label"),
                text.alias("words")))))

    return let(F.regexp_extract_all(line, pattern, F.lit(0)), lambda hits: F.when(
        F.size(hits) == 0, F.array().cast(DETECTIONS)).otherwise(spans(hits)))


def _outermost(found: Column) -> Column:
    """Detections that no other one suppresses, in one pass over them by start.

    What contains a detection comes before it in this order, so the farthest end per priority decides.
    """
    levels = (TAG, ADDRESS, GRANT, NAME)
    order = F.array_sort(F.transform(found, lambda d: F.struct(
        d["first"].alias("a"), (-d["last"]).alias("b"), (-d["priority"]).alias("c"), d["rule"].alias("r"), d.alias("d"))))

    def step(state, item):
        d = item["d"]
        hidden = F.lit(False)
        for level in levels:
            hidden = hidden | ((d["priority"] <= level) & (state[f"e{level}"] >= d["last"]))
        ends = [F.greatest(state[f"e{level}"], F.when(d["priority"] == level, d["last"]).otherwise(F.lit(-1))).alias(
            f"e{level}") for level in levels]
        kept = F.when(hidden, state["kept"]).otherwise(F.concat(state["kept"], F.array(d)))
        return F.struct(*ends, kept.alias("kept"))

    def ends_of(state):
        return [(state[f"e{level}"] if state is not None else F.lit(-1).cast("long")).alias(f"e{level}") for level in levels]

    def some(state, block):
        """A block of detections: what is kept grows only inside it, so that many detections are not copied again and again."""
        inside = F.aggregate(block, F.struct(*ends_of(state), F.array().cast(DETECTIONS).alias("kept")), step)
        return let(inside, lambda x: F.struct(*ends_of(x), F.concat(state["kept"], F.array(x["kept"])).alias("kept")))

    def blocks(all_of):
        return F.transform(F.sequence(F.lit(1), F.size(all_of), F.lit(BLOCK)), lambda i: F.slice(all_of, i, BLOCK))

    first = F.struct(*ends_of(None), F.array().cast(f"array<{DETECTIONS}>").alias("kept"))
    return F.when(F.size(found) == 0, F.array().cast(DETECTIONS)).otherwise(
        F.aggregate(let(order, blocks), first, some, lambda state: F.flatten(state["kept"])))


def scan(docs: DataFrame, text: str = "text", table: list[Rule] | None = None,
         phrases=BASE_PHRASES) -> DataFrame:
    """The input with n_words, base_places (label, place) and detections (first, last, priority, rule, label, words)."""
    table = rules() if table is None else table
    literal = F.array(*[F.struct(F.lit(i).alias("no"), F.lit(r.label).alias("label"), F.array(*[
        F.array(*map(F.lit, g)).cast("array<string>") for g in r.gates]).alias("gates"), F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"))
        for i, r in enumerate(table)])
    gates = F.array(*[F.lit(k) for k in sorted({k for r in table for g in r.gates for k in g})])
    nothing = F.array().cast(DETECTIONS)

    def results(w):
        return let(F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" ")), lambda line: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.array_sort(F.concat(*[F.transform(places(w, line, p), lambda i: F.struct(
                i.cast("long").alias("place"), F.lit(label).alias("label"))) for p, label in phrases])).alias("base_places"),
            let(F.array_intersect(w, gates), lambda seen: let(
                F.filter(literal, lambda r: F.exists(r["gates"], lambda g: F.size(F.array_except(g, seen)) == 0)),
                lambda chosen: F.when(F.size(chosen) == 0, nothing).otherwise(
                    let(F.flatten(F.transform(chosen, lambda r: _hits(line, r))), _outermost)))).alias("detections")))

    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in RESULT]
    made = free_name(docs.columns, "found")
    found = docs.select(*kept, F.explode(F.array(let(
        words(lower_ascii(whole(F.col(f"`{text}`"))), TERM), results))).alias(made))
    return found.select(*[F.col(f"`{c}`") for c in found.columns if c != made], f"{made}.*")


def confidence(base_places: Column, detections: Column) -> Column:
    """0 without a sign of a license, else the share that the strongest detection's priority is of 100; 0.5 for base phrases."""
    return F.greatest(F.coalesce(F.array_max(F.transform(detections, lambda d: d["priority"])), F.lit(0)) / 100.0,
                      F.when(F.size(base_places) > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
