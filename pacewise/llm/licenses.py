"""License detection by ordered signature rules, in DataFrame functions only.

A text that holds none of a few keywords is only counted. Others become words; each word that can begin a
signature opens a view of the next ``VIEW`` words, and the ordered rules are tried there as anchored regexes, each
behind its own keyword: the first rule that matches wins. Of all detections, those inside the words of another
one of at least their priority are suppressed. Everything happens within a row: nothing is shuffled.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewise.llm.common import LOWER, UPPER

#: Words: letters and digits of ASCII, and all beyond ASCII.
_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
#: The base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

@dataclass(frozen=True)
class Rule:
    """``pattern`` is over words in lower case with single blanks; ``gate`` is a word that every match of it
    holds. A smaller ``rank`` goes first and outranks; ``weight`` (0 to 1) is the trust in a detection."""

    rank: int
    label: str
    gate: str
    pattern: str
    weight: float


# Hand-written families. Each name stands for one or several license names; versions are spelled as words.
_LICENSED = ("licensed under", "released under", "distributed under", "available under", "published under", "covered by", "subject to")
_NAMED = (
    ("mit", "mit license"), ("isc", "isc license"), ("zlib", "zlib( libpng)? license"),
    ("bsl-1.0", "boost software license"), ("unlicense", "unlicense"), ("wtfpl", "(wtfpl|what the fuck you want to public license)"),
    ("postgresql", "postgresql license"), ("python-2.0", "(python software foundation|psf|python) license"),
    ("ncsa", "(university of illinois )?ncsa open source license"), ("x11", "x11 license"), ("openssl", "openssl license"),
    ("vim", "vim license"), ("curl", "curl license"), ("ofl-1.1", "sil open font license"),
    ("php-3.01", "php license"), ("ruby", "ruby license"), ("beerware", "beer ?ware license"),
    ("bsd-4-clause", "(bsd 4 clause|4 clause bsd|four clause bsd|original bsd) license"),
    ("bsd-3-clause", "(bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) license"),
    ("bsd-2-clause", "(bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd) license"),
    ("0bsd", "(0bsd|bsd zero clause|zero clause bsd) license"), ("bsd", "bsd( style)? license"),
)
_VERSIONED = (
    ("apache", "apache (software )?license", ("1 0", "1 1", "2 0")),
    ("mpl", "mozilla public license", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse public license", ("1 0", "2 0")),
    ("cpl", "common public license", ("1 0",)),
    ("cddl", "common development and distribution license", ("1 0", "1 1")),
    ("eupl", "european union public licen[cs]e", ("1 0", "1 1", "1 2")),
    ("artistic", "(perl )?artistic license", ("1 0", "2 0")),
    ("osl", "open software license", ("1 0", "1 1", "2 0", "2 1", "3 0")),
    ("afl", "academic free license", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("agpl", "(gnu )?affero general public license", ("1 0", "3 0", "3")),
    ("lgpl", "(gnu )?(lesser|library) general public license", ("2 0", "2 1", "3 0", "2", "3")),
    ("gfdl", "(gnu )?free documentation license", ("1 1", "1 2", "1 3")),
    ("gpl", "(gnu )?general public license", ("1 0", "2 0", "3 0", "1", "2", "3")),
    ("odc-by", "open data commons attribution license", ("1 0",)),
    ("odbl", "open (data commons open )?database license", ("1 0",)),
    ("cecill", "cecill( free software)? license( agreement)?", ("1 0", "1 1", "2 0", "2 1")),
    ("msl", "microsoft (public|reciprocal) license", ()),
)
_CC_TERMS = ("by nc nd", "by nc sa", "by nc", "by nd", "by sa", "by")
_CC_LONG = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(ative)?s( works)?", "sa": "share ?alike"}
_CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
_PLAIN = (
    ("cc0-1.0", "(cc0( 1 0)?|cc zero)", 0.9), ("cc0-1.0", "creative commons zero( 1 0)?", 0.9), ("public-domain", "public domain", 0.6),
    ("public-domain", "public domain dedication", 0.8), ("reserved", "all rights reserved", 0.7), ("reserved", "part of this (publication|work|document) may be reproduced", 0.9),
    ("copyright", "copyright c? ?(19|20)[0-9]{2}", 0.5), ("proprietary", "proprietary and confidential", 0.8), ("proprietary", "confidential and proprietary", 0.8),
    ("permissive", "permission is hereby granted free of charge to any person", 1.0), ("permissive", "permission to use copy modify and( or)? distribute this software", 1.0),
    ("bsd", "redistribution and use in source and binary forms", 1.0), ("gpl", "gpl ?v?[123]( 0)?( only| or later)?", 0.8), ("lgpl", "lgpl ?v?[23]( [01])?( only| or later)?", 0.8),
    ("agpl", "agpl ?v?[13]( 0)?( only| or later)?", 0.8), ("creative-commons", "creative commons( license)?", 0.5), ("gpl", "general public license", 0.6),
    ("unknown-license", "licensed under", 0.3),
)
_SPDX = (
    "mit", "isc", "zlib", "unlicense", "bsl 1 0", "apache 1 1", "apache 2 0", "bsd 2 clause", "bsd 3 clause", "bsd 4 clause", "0bsd", "mpl 1 1", "mpl 2 0", "epl 1 0", "epl 2 0",
    "cddl 1 0", "cddl 1 1", "eupl 1 1", "eupl 1 2", "artistic 1 0", "artistic 2 0", "gpl 1 0", "gpl 2 0", "gpl 3 0", "lgpl 2 0", "lgpl 2 1", "lgpl 3 0", "agpl 1 0", "agpl 3 0",
    "gfdl 1 2", "gfdl 1 3", "cc0 1 0", "ofl 1 1", "wtfpl", "ncsa", "postgresql", "python 2 0", "x11", "openssl", "vim", "php 3 01", "ruby", "odbl 1 0", "cecill 2 1",
)


def _dashed(name: str, version: str = "") -> str:
    return name.replace(" ", "-") + (f"-{version.replace(' ', '.')}" if version else "")


def _spdx_label(name: str) -> str:
    head, *rest = name.split(" ")
    if rest and rest[-1] == "clause":
        return "-".join([head, *rest])
    return f"{head}-{'.'.join(rest)}" if rest else head


def rules() -> list[Rule]:
    """All rules in order: the more a rule says, the smaller its rank."""
    found: list[tuple[int, str, str, float]] = []
    suffix = "( only| or later| or any later version| or at your option any later version)?"
    for name in _SPDX:
        found.append((0, _spdx_label(name), f"spdx license identifier {name}{suffix}", 1.0))
    for name, phrase, versions in _VERSIONED:
        for version in versions:
            label = _dashed(name, version)
            found.append((1, label, f"{phrase}( version| v)? ?{version}{suffix}", 1.0))
            for lead in _LICENSED:
                found.append((0, label, f"{lead} (the )?{phrase}( version| v)? ?{version}{suffix}", 1.0))
        found.append((3, name, f"{phrase}{suffix}", 0.7))
        for lead in _LICENSED[:3]:
            found.append((2, name, f"{lead} (the )?{phrase}{suffix}", 0.9))
    for name, phrase in _NAMED:
        found.append((2, name, phrase, 0.9))
        for lead in _LICENSED:
            found.append((1, name, f"{lead} (the )?{phrase}", 1.0))
    for terms in _CC_TERMS:
        long = " ".join(_CC_LONG[t] for t in terms.split(" "))
        for version in _CC_VERSIONS:
            label = _dashed(f"cc {terms}", version)
            found.append((1, label, f"cc {terms} {version}", 1.0))
            for lead in _LICENSED[:2]:
                found.append((0, label, f"{lead} (a |the )?cc {terms} {version}", 1.0))
            found.append((1, label, f"creative commons {long}( {version}( international| unported)?| international license {version})( license)?", 1.0))
        found.append((2, _dashed(f"cc {terms}"), f"cc {terms}", 0.8))
        found.append((2, _dashed(f"cc {terms}"), f"creative commons {long}( license)?", 0.8))
    for label, pattern, weight in _PLAIN:
        found.append((4, label, pattern, weight))
    order = sorted(range(len(found)), key=lambda i: (found[i][0], i))
    return [Rule(found[i][0], found[i][1], _gate(found[i][2]), found[i][2], found[i][3]) for i in order]


def _heads(pattern: str) -> list[str]:
    """The first words that a pattern can begin with, spelled out from its leading groups."""
    pattern = pattern.strip()
    if not pattern.startswith("("):
        head = pattern.split(" ")[0].split("(")[0]
        return [head.removesuffix("?")] if "?" not in head and "[" not in head else [head.split("?")[0].split("[")[0]]
    depth, end = 0, 0
    for end, sign in enumerate(pattern):
        depth += (sign == "(") - (sign == ")")
        if not depth:
            break
    inside, rest = pattern[1:end], pattern[end + 1 :]
    found = [h for option in _options(inside) for h in _heads(option)]
    return found + (_heads(rest[1:]) if rest.startswith("?") else [])


def _options(inside: str) -> list[str]:
    out, depth, at = [], 0, 0
    for place, sign in enumerate(inside):
        depth += (sign == "(") - (sign == ")")
        if sign == "|" and not depth:
            out.append(inside[at:place])
            at = place + 1
    return [*out, inside[at:]]


def _gate(pattern: str) -> str:
    """A plain word that every match of the pattern holds: its longest outside groups and optional signs."""
    plain, depth = [], 0
    for word in pattern.replace("(", " ( ").replace(")", " ) ").split():
        depth += (word == "(") - (word == ")")
        if not depth and word.isalnum():
            plain.append(word)
    return max(plain, key=len, default="")  # without one, the regex alone decides


def _most_words(pattern: str) -> int:
    """Words of the longest match of a pattern, every option taken."""
    most, at = 1, 0
    while at < len(pattern):
        if pattern[at] == "(":
            depth, end = 1, at + 1
            while depth:
                depth += (pattern[end] == "(") - (pattern[end] == ")")
                end += 1
            most += max(_most_words(option) for option in _options(pattern[at + 1 : end - 1])) - 1
            at = end
        else:
            most += pattern[at] == " "
            at += 1
    return most


#: Words that a rule may look at: those of the longest match.
VIEW = max(_most_words(rule.pattern) for rule in rules())

#: What a text must hold so that a rule or base phrase can match; all in lower case, and within a word: anything may stand between words.
KEYWORDS = ("licen", "copyright", "reserved", "domain", "creative", "unlicense", "wtfpl", "gpl", "cc", "permission", "redistribution", "proprietary", "reproduced")


def _lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


_RULE = "struct<rank:int,label:string,weight:double,gate:string,pattern:string>"


def _by_head() -> dict[str, list[dict]]:
    """The ordered rules under each word that their match can begin with."""
    found: dict[str, list[dict]] = {}
    for rule in rules():
        entry = {"rank": rule.rank, "label": rule.label, "weight": rule.weight, "gate": rule.gate, "pattern": f"^(?:{rule.pattern})(?= |$)"}
        for head in dict.fromkeys(_heads(rule.pattern)):
            found.setdefault(head, []).append(entry)
    return found


def _head(word: Column, heads: list[str]) -> Column:
    """The rules' head that a word stands for, or null."""
    head = F.when(word.isin([h for h in heads if h not in _OPEN]), word)
    for prefix in _OPEN:
        head = head.when(word.startswith(prefix), F.lit(prefix))
    return head


def _first_rule(view: Column, head: Column, every: Column) -> Column:
    """The first rule that matches the view's beginning, with the match's number of words, or null."""
    fit = F.filter(F.element_at(every, head), lambda r: view.contains(r["gate"]) & F.regexp_like(view, r["pattern"]))
    rule = F.get(fit, F.lit(0))
    return F.when(F.size(fit) > 0, F.struct(rule.alias("rule"), F.size(F.split(F.regexp_substr(view, rule["pattern"]), " ")).alias("n")))


def _places(words: Column, phrase: str) -> Column:
    """Starts (words from 0) of a phrase."""
    parts = phrase.split(" ")
    last = F.size(words) - len(parts)
    every = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))

    def here(i: Column) -> Column:
        fits = F.get(words, i) == parts[0]
        for k, part in enumerate(parts[1:], start=1):
            fits = fits & (F.get(words, i + k) == part)
        return fits

    return F.filter(every, here)


def licenses(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and ``detections`` (label, first
    word, end word) of every row.

    Null and empty texts have no words, no labels, null places and score 0. Base phrases count at every place, also
    inside other detections; suppression only concerns the rules' own labels. The score is the greatest weight
    of the kept detections, 0.5 at least with a base phrase. Rows are independent: null and repeated doc_ids give
    a row each; other columns of ``docs`` are not read.
    """
    text = F.coalesce("text", F.lit(""))
    low = F.lower(text)
    gated = low.contains(KEYWORDS[0])
    for word in KEYWORDS[1:]:
        gated = gated | low.contains(word)
    none = F.array().cast("array<string>")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.regexp_count("text", F.lit(_WORD)).cast("long").alias("n_words"),
        F.when(gated, F.regexp_extract_all(_lowered(F.col("text")), F.lit(_WORD), 0)).otherwise(none).alias("words"),
    )
    table = _by_head()
    every = F.from_json(F.lit(json.dumps(table)), f"map<string,array<{_RULE}>>")
    heads = F.transform("words", lambda w, i: F.struct(i.alias("at"), _head(w, sorted(table)).alias("head")))
    rows = rows.withColumn("views", F.transform(
        F.filter(heads, lambda h: h["head"].isNotNull()),
        lambda h: F.struct(h["at"].alias("at"), h["head"].alias("head"), F.array_join(F.slice("words", h["at"] + 1, F.lit(VIEW)), " ").alias("view"))))
    hits = F.transform("views", lambda v: F.struct(v["at"].alias("at"), _first_rule(v["view"], v["head"], every).alias("found")))
    rows = rows.withColumn("hits", F.transform(F.filter(hits, lambda d: d["found"].isNotNull()), lambda d: F.struct(
        d["at"].alias("start"), (d["at"] + d["found"]["n"]).alias("end"),
        *(d["found"]["rule"][name].alias(name) for name in ("rank", "label", "weight")))))

    # only one detection starts at a word, and none is longer than the view: containers are near in the array
    def suppressed(d: Column, k: Column) -> Column:
        near = F.slice("hits", F.greatest(k - VIEW + 1, F.lit(1)), F.lit(2 * VIEW))
        return F.exists(near, lambda e: (e["start"] <= d["start"]) & (e["end"] >= d["end"]) & (e["rank"] <= d["rank"]) & ((e["start"] != d["start"]) | (e["end"] != d["end"])))

    rows = rows.withColumn("detections", F.filter("hits", lambda d, k: ~suppressed(d, k)))
    for number, (phrase, _) in enumerate(BASE):
        rows = rows.withColumn(f"base_{number}", _places(F.col("words"), phrase))
    starts = F.concat(*(F.col(f"base_{n}") for n in range(len(BASE))))
    base = F.filter(F.array(*(F.when(F.size(f"base_{n}") > 0, F.lit(label)) for n, (_, label) in enumerate(BASE))), lambda x: x.isNotNull())
    labels = F.array_sort(F.array_distinct(F.concat(base, F.transform("detections", lambda d: d["label"]))))
    weight = F.array_max(F.transform("detections", lambda d: d["weight"]))
    return rows.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"), F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"), F.array_join(F.array_sort(base), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"),
        F.greatest(F.coalesce(weight, F.lit(0.0)), F.when(F.size(starts) > 0, 0.5).otherwise(0.0)).alias("score"),
        F.transform("detections", lambda d: F.struct(d["label"].alias("label"), d["start"].alias("first_word"), d["end"].alias("end_word"))).alias("detections"))


#: First words that go on without a blank in some rules.
_OPEN = ("gpl", "lgpl", "agpl", "beer", "cc0")
