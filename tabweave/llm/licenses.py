"""License scan by ordered signature rules.

A rule is a regular expression over a text's words, lower-cased and joined by single spaces, behind a keyword
that the words must contain. Detections of all rules are ordered by priority and length, and one that lies
within an earlier one is suppressed: the family's name inside its full title, say, or a title inside its
license identifier.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabweave.llm.text import free_name, lower_ascii

# A word is a run of ASCII letters and digits and of all characters beyond ASCII.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

IDENTIFIER, TITLE, NOTICE, FAMILY = 0, 1, 2, 3
PRIORITIES = 4


@dataclass(frozen=True)
class Rule:
    """A signature: its label, keyword and pattern, its priority (0 comes first) and its confidence."""

    label: str
    keyword: str
    pattern: str
    priority: int
    score: float


# Phrases that count as base detections, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Families with their full name, short name and versions.
_VERSIONED = [
    ("gpl", "gnu general public license", "gpl", ["1.0", "2.0", "3.0"]),
    ("lgpl", "gnu lesser general public license", "lgpl", ["2.0", "2.1", "3.0"]),
    ("agpl", "gnu affero general public license", "agpl", ["1.0", "3.0"]),
    ("gfdl", "gnu free documentation license", "gfdl", ["1.1", "1.2", "1.3"]),
    ("apache", "apache (?:software )?license", "apache", ["1.0", "1.1", "2.0"]),
    ("mpl", "mozilla public license", "mpl", ["1.0", "1.1", "2.0"]),
    ("epl", "eclipse public license", "epl", ["1.0", "2.0"]),
    ("cpl", "common public license", "cpl", ["1.0"]),
    ("cddl", "common development and distribution license", "cddl", ["1.0", "1.1"]),
    ("eupl", "european union public license", "eupl", ["1.0", "1.1", "1.2"]),
    ("osl", "open software license", "osl", ["1.0", "1.1", "2.0", "2.1", "3.0"]),
    ("afl", "academic free license", "afl", ["1.1", "1.2", "2.0", "2.1", "3.0"]),
    ("artistic", "artistic license", "artistic", ["1.0", "2.0"]),
    ("bsl", "boost software license", "bsl", ["1.0"]),
    ("odbl", "open database license", "odbl", ["1.0"]),
    ("php", "php license", "php", ["3.0", "3.01"]),
    ("psf", "python software foundation license", "psf", ["2.0"]),
    ("zpl", "zope public license", "zpl", ["1.1", "2.0", "2.1"]),
    ("lppl", "latex project public license", "lppl", ["1.0", "1.1", "1.2", "1.3"]),
    ("ofl", "sil open font license", "ofl", ["1.0", "1.1"]),
    ("qpl", "q public license", "qpl", ["1.0"]),
    ("apsl", "apple public source license", "apsl", ["1.0", "1.1", "1.2", "2.0"]),
    ("cecill", "cecill (?:free software )?license", "cecill", ["1.0", "1.1", "2.0", "2.1"]),
]
# Families without versions, by their names.
_PLAIN = {
    "mit": "(?:the )?mit (?:x11 )?license",
    "isc": "(?:the )?isc license",
    "zlib": "(?:the )?zlib(?: libpng)? license",
    "unlicense": "(?:the )?unlicense",
    "wtfpl": "do what the fuck you want to public license",
    "bsd-2-clause": "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd) license",
    "bsd-3-clause": "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) license",
    "bsd-4-clause": "(?:bsd 4 clause|4 clause bsd|original bsd) license",
    "0bsd": "(?:bsd zero clause|0 clause bsd) license",
    "bsd": "(?:the )?bsd (?:style )?license",
    "openssl": "openssl license",
    "ncsa": "university of illinois ncsa open source license",
    "vim": "vim license",
    "ruby": "ruby license",
    "postgresql": "postgresql license",
    "beerware": "beer ?ware license",
    "proprietary": "(?:proprietary|commercial) licen[sc]e(?: agreement)?",
}
# Sentences that licenses and notices are known by.
_NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("apache", "licensed under the apache license(?: version \\d+(?: \\d+)?)?"),
    ("gpl", "under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("warranty", "without warranty of any kind(?: express or implied)?"),
    ("warranty", "without any warranty without even the implied warranty"),
    ("copyright", "copyright (?:c )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)*"),
    ("copyright", "(?:c|©) copyright(?: (?:19|20)\\d\\d)?"),
    ("public-domain", "(?:released into|dedicated to|placed in|in) the public domain"),
    ("reserved", "(?:all|some|no) rights (?:are )?reserved"),
    ("proprietary", "confidential and licensed material"),
]
# The licenses of Creative Commons and their versions.
_COMMONS = {
    "by": "attribution",
    "by-sa": "attribution share ?alike",
    "by-nc": "attribution non ?commercial",
    "by-nd": "attribution no ?deriv(?:ative)?s",
    "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s",
}
_COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]

# One of these is part of every match; a text without any is not looked at further.
GATES = ["licen", "copyright", "reserved", "cc", "creative", "public", "redistribution", "permission", "warrant"]


def _version(number: str) -> str:
    """Pattern of a version's words; a last 0 may be missing."""
    major, _, minor = number.partition(".")
    return f"v?{major}(?: 0)?" if minor == "0" else f"v?{major} {minor}"


def _plain_part(pattern: str) -> str:
    """The longest stretch of a pattern that stands for itself, which any text that matches it has."""
    fixed = re.sub(r"\(\?:[^()]*(?:\([^()]*\)[^()]*)*\)\??|\[[^]]*\]\??|.\?|\\\\.", "|", pattern)
    return max(fixed.split("|"), key=len)


def rules() -> list[Rule]:
    """All signature rules, some hundreds, made from the tables of families, versions and sentences."""
    made = []

    def add(label: str, pattern: str, priority: int, score: float) -> None:
        made.append(Rule(label, _plain_part(pattern), pattern, priority, score))

    later = "(?: or (?:any )?(?:later|newer)(?: version)?)?"
    for family, name, short, versions in _VERSIONED:
        for number in versions:
            label, v = f"{family}-{number}", _version(number)
            add(label, f"{name}(?: {short})?(?: version| v)? {v}{later}", TITLE, 0.95)
            add(label, f"(?:version )?{v} of the {name}{later}", TITLE, 0.95)
            add(label, f"licen[sc]ed? (?:under )?(?:the )?{short} ?{v}{later}", TITLE, 0.9)
            add(label, f"spdx license identifier {short} {v}(?: only| or later)?", IDENTIFIER, 1.0)
        add(family, name, FAMILY, 0.7)
    for family, name in _PLAIN.items():
        spoken = family.replace("-", " ")
        under = "licen[sc]ed under (?:the )?(?:terms of )?(?:the )?"
        add(family, name, TITLE, 0.9)
        add(family, f"{under}{spoken}(?: license)?", NOTICE, 0.8)
        add(family, f"spdx license identifier {spoken}", IDENTIFIER, 1.0)
    for (code, name), number in product(_COMMONS.items(), _COMMONS_VERSIONS):
        label, v, words = f"cc-{code}-{number}", _version(number), code.replace("-", " ")
        place = "(?: international| unported| generic)?"
        add(label, f"creative commons {name}(?: license)?(?: version)? {v}{place}", TITLE, 0.95)
        add(label, f"cc {words} {v}", TITLE, 0.95)
        add(label, f"spdx license identifier cc {words} {v}", IDENTIFIER, 1.0)
    for code, name in _COMMONS.items():
        add(f"cc-{code}", f"creative commons {name}", FAMILY, 0.8)
        add(f"cc-{code}", f"cc {code.replace('-', ' ')}", FAMILY, 0.8)
    add("cc0-1.0", "cc0(?: 1(?: 0)?)?(?: universal)?", TITLE, 0.95)
    add("cc0-1.0", "creative commons (?:zero|cc0)(?: 1(?: 0)?)?(?: universal)?", TITLE, 0.95)
    add("public-domain", "public domain", FAMILY, 0.5)
    for label, pattern in _NOTICES:
        add(label, pattern, NOTICE, 0.85)
    return made


def _spaces(text: Column) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(" "), F.lit("")))


def _spans(words: Column, pattern: Column) -> Column:
    """First and last word, from 0, of each place where the pattern matches whole words; places do not overlap."""
    whole = F.concat(F.lit("(?<![^ ])(?:"), pattern, F.lit(")(?![^ ])"))
    empty = F.array().cast("array<struct<first:int,last:int>>")

    def walk(hits: Column) -> Column:
        def step(state: Column, part: Column) -> Column:
            first = state["at"] + part["gap"]
            span = F.struct(first.alias("first"), (first + part["hit"]).alias("last"))
            return F.struct((first + part["hit"]).alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

        gaps = F.split(words, whole, F.lit(-1))
        parts = F.zip_with(
            F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.struct(_spaces(g).alias("gap"), _spaces(h).alias("hit"))
        )
        start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))
        return F.aggregate(parts, start, step, lambda s: s["spans"])

    # The text is cut at the places only if there are any.
    hits = F.filter(F.array(F.regexp_extract_all(words, whole, F.lit(0))), lambda h: F.size(h) > 0)
    return F.flatten(F.transform(hits, walk))


def _detections(words: Column, table: Column) -> Column:
    """Detections of all rules of an array of (keyword, rules) whose keywords the words contain."""

    def of(rule: Column) -> Column:
        return F.transform(_spans(words, rule["pattern"]), lambda s: F.struct(
            s["first"].alias("first"), (-s["last"]).alias("minus_last"), rule["priority"].alias("priority"),
            rule["place"].alias("place"), rule["label"].alias("label"), rule["score"].alias("score"),
        ))

    held = F.flatten(F.transform(F.filter(table, lambda t: F.contains(words, t["keyword"])), lambda t: t["rules"]))
    return F.flatten(F.transform(held, of))


def suppressed(detections: Column) -> Column:
    """The detections that do not lie within one of better priority, or of the same that is longer or comes earlier.

    Ordered by first word, longest first, whatever a detection lies within comes before it; the furthest last
    word so far of each priority tells whether there is such a one. One pass, whatever the overlaps.
    """
    kind = "array<struct<first:int,minus_last:int,priority:int,place:int,label:string,score:double>>"
    ends = F.array_repeat(F.lit(-1), PRIORITIES)

    def step(state: Column, d: Column) -> Column:
        last = -d["minus_last"]
        inside = F.array_max(F.slice(state["ends"], F.lit(1), d["priority"] + 1)) >= last
        further = F.transform(state["ends"], lambda e, p: F.when(p == d["priority"], F.greatest(e, last)).otherwise(e))
        kept = F.when(inside, state["kept"]).otherwise(F.concat(state["kept"], F.array(d)))
        return F.struct(further.alias("ends"), kept.alias("kept"))

    start = F.struct(ends.alias("ends"), F.array().cast(kind).alias("kept"))
    return F.aggregate(F.array_sort(detections), start, step, lambda s: s["kept"])


def _table(made: list[Rule]) -> Column:
    """The rules by keyword, as a constant."""
    by_keyword: dict[str, list[Column]] = {}
    for i, r in enumerate(made):
        fields = {"pattern": r.pattern, "priority": r.priority, "place": i, "label": r.label, "score": r.score}
        rule = F.struct(*[F.lit(v).alias(n) for n, v in fields.items()])
        by_keyword.setdefault(r.keyword, []).append(rule)
    return F.array(*[F.struct(F.lit(k).alias("keyword"), F.array(*v).alias("rules")) for k, v in by_keyword.items()])


def scan_licenses(docs: DataFrame, text: str = "text", made: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``base`` and ``detections``; columns of these names are replaced.

    ``base`` has the places of the phrases of ``BASE`` and is never suppressed; ``detections`` those of the
    signature rules that are left after suppression. Both have first and last word, label and score. A text
    without words, or null, has none. Rows are not shuffled: the scan is a projection of each row.
    """
    made = rules() if made is None else made
    base = docs.drop(*[c for c in ("n_words", "base", "detections") if c != text])
    words, hits = (free_name(x, base.columns) for x in ("_words", "_found"))
    source = F.col(f"`{text}`")
    phrases = [Rule(label, phrase, phrase, 0, 0.5) for phrase, label in BASE.items()]
    kind = "array<struct<first:int,minus_last:int,priority:int,place:int,label:string,score:double>>"
    none = F.array().cast(kind)
    # Lower-casing by Unicode only lets more texts through than that of A-Z.
    gate = F.exists(F.array(F.lower(source)), lambda t: reduce(lambda a, b: a | b, [F.contains(t, F.lit(g)) for g in GATES]))
    joined = F.array_join(F.regexp_extract_all(lower_ascii(source), F.lit(WORDS), F.lit(0)), " ")
    scanned = base.withColumns({
        "n_words": F.coalesce(F.regexp_count(source, F.lit(_ANY_CASE)), F.lit(0)).cast("bigint"),
        words: F.when(gate, joined),
    })
    found = F.transform(F.array(F.col(words)), lambda w: F.struct(
        _detections(w, _table(phrases)).alias("base"), suppressed(_detections(w, _table(made))).alias("rest")))[0]
    scanned = scanned.withColumn(hits, F.when(F.col(words).isNotNull(), found))

    def plain(field: str) -> Column:
        spans = F.coalesce(F.col(hits)[field], none)
        return F.transform(spans, lambda d: F.struct(
            d["first"].alias("first"), (-d["minus_last"]).alias("last"), d["label"].alias("label"), d["score"].alias("score")))

    return scanned.withColumns({"base": plain("base"), "detections": plain("rest")}).drop(words, hits)
