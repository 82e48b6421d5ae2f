"""License scans: ordered signature rules gated by a keyword prefilter.

Texts are normalised to their words (A-Z lower-cased; a word is a run of digits, a-z and
characters beyond ASCII) joined by single spaces, so a rule is a regular expression over
words and punctuation never matters. Every rule names one keyword; a text runs only the
rules whose keyword is among its words. The keyword test is a hash intersection in the
JVM, and only texts with a keyword cross to Python, where the gated rules' matches become
word intervals. Overlapping detections are resolved by priority and containment: a
detection lying inside another of higher priority, or of equal priority and longer, is
suppressed (a more specific text such as "lesser general public license" beats the
general one it contains). Partial overlaps keep both.

Base phrases are counted apart, in the JVM, as places where their words stand
consecutively; their labels always stay. The score joins the confidences of all kept
detections and base places by noisy-or: 0 without any, near 1 with strong evidence.

Defined cases: a null text is empty (no words, no places, score 0, null first and last
word); very long texts are scanned whole, in linear time per gated rule; repeated rows
give equal results; an empty table gives an empty result; input columns named like a
result column are replaced.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.llm.columns import without

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RESULT = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")

# The base phrases and their labels.
BASE_PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
BASE_CONFIDENCE = 0.9
#: No rule matches more words than this; containment is looked for that far back.
LONGEST = 64

# Hand-written signatures: (label, priority, confidence, keyword, words pattern).
# Patterns read normalised words separated by single spaces.
_V = r"(?:v(?:ersion)? ?)?"
HAND_RULES: tuple[tuple[str, int, float, str, str], ...] = (
    ("mit", 30, 0.99, "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 20, 0.8, "mit", r"(?:the )?mit licen[cs]e"),
    ("mit", 20, 0.85, "mit", r"licen[cs]ed under (?:the )?(?:terms of the )?mit(?: licen[cs]e)?"),
    ("mit", 10, 0.5, "mit", r"spdx licen[cs]e identifier mit"),
    ("mit-0", 25, 0.9, "mit", r"mit no attribution|mit 0"),
    ("x11", 25, 0.85, "x11", r"x11 licen[cs]e"),
    ("expat", 25, 0.85, "expat", r"expat licen[cs]e"),
    ("apache-2", 30, 0.99, "apache", r"licensed under the apache licen[cs]e version 2 0 the licen[cs]e"),
    ("apache-2", 20, 0.85, "apache", rf"apache licen[cs]e {_V}2(?: 0)?"),
    ("apache-2", 20, 0.8, "apache", r"apache 2 0(?: licen[cs]e)?|apache v2|asl 2 0|al 2 0 licen[cs]e"),
    ("apache-2", 15, 0.95, "apache", r"www apache org licenses license 2 0"),
    ("apache-1.1", 20, 0.85, "apache", rf"apache licen[cs]e {_V}1 1"),
    ("apache-1", 20, 0.8, "apache", rf"apache licen[cs]e {_V}1(?: 0)?(?! 1)"),
    ("apache", 5, 0.4, "apache", r"apache licen[cs]e"),
    ("bsd-2", 25, 0.9, "bsd", r"(?:simplified|freebsd|2 clause) bsd licen[cs]e|bsd 2 clause(?: licen[cs]e)?"),
    ("bsd-3", 25, 0.9, "bsd", r"(?:new|modified|revised|3 clause) bsd licen[cs]e|bsd 3 clause(?: licen[cs]e)?"),
    ("bsd-4", 25, 0.9, "bsd", r"(?:original|4 clause) bsd licen[cs]e|bsd 4 clause(?: licen[cs]e)?"),
    ("bsd", 5, 0.5, "bsd", r"bsd licen[cs]e|bsd style licen[cs]e"),
    ("bsd-3", 28, 0.97, "endorse", r"neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote"),
    ("bsd-2", 26, 0.95, "redistributions", r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("isc", 25, 0.9, "isc", r"isc licen[cs]e"),
    ("isc", 28, 0.97, "permission", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", 25, 0.9, "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("zlib", 28, 0.95, "altered", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", 25, 0.95, "unlicense", r"the unlicense|unlicense org"),
    ("unlicense", 28, 0.97, "released", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", 25, 0.9, "wtfpl", r"wtfpl|do what the fuck you want to public licen[cs]e"),
    ("0bsd", 25, 0.9, "bsd", r"zero clause bsd|0bsd|bsd zero clause"),
    ("bsl-1.0", 25, 0.9, "boost", rf"boost software licen[cs]e {_V}1 0|boost software licen[cs]e"),
    ("artistic-2", 25, 0.9, "artistic", rf"artistic licen[cs]e {_V}2(?: 0)?"),
    ("artistic", 15, 0.6, "artistic", r"artistic licen[cs]e"),
    ("psf-2", 25, 0.9, "python", r"python software foundation licen[cs]e(?: version 2)?|psf licen[cs]e"),
    ("php-3", 25, 0.9, "php", rf"php licen[cs]e {_V}3(?: [0-9]+)?"),
    ("ruby", 20, 0.8, "ruby", r"ruby licen[cs]e"),
    ("postgresql", 25, 0.9, "postgresql", r"postgresql licen[cs]e"),
    ("openssl", 25, 0.9, "openssl", r"openssl licen[cs]e"),
    ("ofl-1.1", 25, 0.9, "font", rf"sil open font licen[cs]e {_V}1 1|ofl 1 1"),
    ("ofl", 15, 0.7, "font", r"sil open font licen[cs]e|open font licen[cs]e"),
    ("mpl-2", 25, 0.9, "mozilla", rf"mozilla public licen[cs]e {_V}2(?: 0)?|mpl 2 0"),
    ("mpl-1.1", 25, 0.9, "mozilla", rf"mozilla public licen[cs]e {_V}1 1|mpl 1 1"),
    ("mpl", 10, 0.6, "mozilla", r"mozilla public licen[cs]e"),
    ("mpl-2", 28, 0.97, "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("epl-2", 25, 0.9, "eclipse", rf"eclipse public licen[cs]e {_V}2(?: 0)?|epl 2 0"),
    ("epl-1", 25, 0.9, "eclipse", rf"eclipse public licen[cs]e {_V}1(?: 0)?|epl 1 0"),
    ("epl", 10, 0.6, "eclipse", r"eclipse public licen[cs]e"),
    ("cddl-1", 25, 0.9, "cddl", r"common development and distribution licen[cs]e(?: version 1 [01])?|cddl(?: 1 [01])?"),
    ("eupl-1.2", 25, 0.9, "eupl", rf"european union public licen[cs]e {_V}1 2|eupl 1 2"),
    ("eupl", 15, 0.7, "eupl", r"european union public licen[cs]e|eupl"),
    ("ms-pl", 25, 0.9, "microsoft", r"microsoft public licen[cs]e|ms pl"),
    ("ms-rl", 25, 0.9, "microsoft", r"microsoft reciprocal licen[cs]e|ms rl"),
    ("cecill", 25, 0.85, "cecill", rf"cecill(?: {_V}[0-9](?: [0-9])?)?"),
    ("odbl", 25, 0.9, "odbl", r"open database licen[cs]e|odbl(?: 1 0)?"),
    ("odc-by", 25, 0.9, "odc", r"open data commons attribution licen[cs]e|odc by(?: 1 0)?"),
    ("pddl", 25, 0.9, "pddl", r"public domain dedication and licen[cs]e|pddl"),
    ("cc0-1.0", 28, 0.95, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", 28, 0.95, "zero", r"creative commons zero(?: v1 0)?(?: universal)?"),
    ("cc-pdm", 25, 0.85, "mark", r"public domain mark(?: 1 0)?"),
    ("public-domain", 10, 0.6, "domain", r"(?:placed|released|dedicated) (?:in|into|to) the public domain|in the public domain"),
    ("gfdl", 20, 0.85, "documentation", rf"gnu free documentation licen[cs]e(?: {_V}1 [23])?|gfdl(?: 1 [23])?"),
    ("gpl", 5, 0.5, "gpl", r"gpl|gnu gpl"),
    ("gpl", 6, 0.6, "general", r"gnu general public licen[cs]e|general public licen[cs]e"),
    ("lgpl", 8, 0.6, "lesser", r"gnu lesser general public licen[cs]e|lesser general public licen[cs]e"),
    ("lgpl", 8, 0.6, "library", r"gnu library general public licen[cs]e|library general public licen[cs]e"),
    ("lgpl", 7, 0.5, "lgpl", r"lgpl"),
    ("agpl", 8, 0.6, "affero", r"gnu affero general public licen[cs]e|affero general public licen[cs]e"),
    ("agpl", 7, 0.5, "agpl", r"agpl"),
    ("gpl", 26, 0.95, "warranty", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", 26, 0.95, "warranty", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("proprietary", 15, 0.7, "proprietary", r"proprietary and confidential|proprietary licen[cs]e|proprietary software"),
    ("proprietary", 12, 0.6, "unauthorized", r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("all-rights-reserved", 10, 0.5, "reserved", r"all rights reserved"),
    ("commercial", 10, 0.5, "commercial", r"commercial licen[cs]e"),
    ("noncommercial", 10, 0.6, "noncommercial", r"non ?commercial use only|for noncommercial purposes"),
    ("copyright", 2, 0.3, "copyright", r"copyright(?: c)? (?:[0-9]{4})(?: [0-9]{4})?"),
    ("as-is", 3, 0.4, "warranty", r"provided as is without warranty of any kind"),
    ("json", 25, 0.9, "evil", r"the software shall be used for good not evil"),
    ("beerware", 25, 0.9, "beer", r"beer ?ware licen[cs]e|buy me a beer in return"),
    ("cc-by", 8, 0.5, "creative", r"creative commons licen[cs]e|creative commons"),
)

# Rule families built from parameters: Creative Commons kinds by version and spelling,
# GNU licenses by version with "only" and "or later".
CC_KINDS = (
    ("by", "attribution"),
    ("by-sa", "attribution sharealike"),
    ("by-nd", "attribution noderivatives|attribution no derivatives|attribution noderivs"),
    ("by-nc", "attribution noncommercial|attribution non commercial"),
    ("by-nc-sa", "attribution noncommercial sharealike|attribution non commercial share alike"),
    ("by-nc-nd", "attribution noncommercial noderivatives|attribution noncommercial no derivatives|attribution non commercial no derivatives"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
GNU = (("gpl", "general public", ("1", "2", "3")), ("lgpl", "lesser general public", ("2 1", "3")),
       ("lgpl", "library general public", ("2", "2 0")), ("agpl", "affero general public", ("3",)))


def _family_rules() -> list[tuple[str, int, float, str, str]]:
    rules = []
    for kind, words in CC_KINDS:
        short = kind.replace("-", " ")
        long = "|".join(f"creative commons {w}" for w in words.split("|"))
        rules.append((f"cc-{kind}", 20, 0.85, "cc", rf"cc {short}(?! (?:nc|sa|nd))"))
        rules.append((f"cc-{kind}", 22, 0.9, "creative", rf"(?:{long})(?! (?:non|noderiv|no deriv|share))"))
        for version in CC_VERSIONS:
            label = f"cc-{kind}-{version.replace(' ', '.')}"
            rules.append((label, 30, 0.95, "cc", rf"cc {short} {version}"))
            rules.append((label, 32, 0.97, "creative", rf"(?:{long}) {version}(?: (?:international|unported|generic))?(?: licen[cs]e)?"))
    for short, long, versions in GNU:
        key = long.split()[0]
        later = r"(?: or \(?at your option\)? any later version| or later| or any later version|\+)"
        for version in versions:
            label = f"{short}-{version.replace(' ', '.')}"
            # The long names are gated by their first word, the short ones by themselves.
            for keyword, name in ((key, rf"(?:gnu )?{long} licen[cs]e {_V}{version}"), (short, rf"{short} ?v?{version}")):
                rules.append((f"{label}-or-later", 40, 0.95, keyword, rf"{name}{later}"))
                rules.append((f"{label}-only", 36, 0.9, keyword, rf"{name} only"))
                rules.append((label, 30, 0.9, keyword, name))
    return rules


RULES = tuple(HAND_RULES) + tuple(_family_rules())


def normalised(text: Column) -> Column:
    """The words of a text (null: empty), A-Z lower-cased."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def base_places(words: Column, phrase: str) -> Column:
    """Word indexes where the phrase's words stand consecutively."""
    parts = phrase.split()
    k = len(parts)

    def at(i: Column) -> Column:
        condition = words[i] == F.lit(parts[0])
        for offset, part in enumerate(parts[1:], 1):
            condition = condition & (words[i + offset] == F.lit(part))
        return condition

    places = F.filter(F.sequence(F.lit(0), F.size(words) - k), at)
    return F.when(F.size(words) >= k, places).otherwise(F.array().cast("array<int>"))


@lru_cache(maxsize=4)
def _compiled(rules: tuple) -> dict[str, list[tuple[str, int, float, re.Pattern]]]:
    by_keyword: dict[str, list] = {}
    for label, priority, confidence, keyword, pattern in rules:
        wrapped = re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])")
        by_keyword.setdefault(keyword, []).append((label, priority, confidence, wrapped))
    return by_keyword


def detect(words: str, keywords: Iterable[str], rules: tuple = RULES) -> list[dict]:
    """Kept detections of the rules gated by ``keywords`` in a normalised text.

    Returns dicts of label, start and end (word indexes, end exclusive), priority and
    confidence, ordered by start, end and label.
    """
    if not words:
        return []
    compiled = _compiled(rules)
    starts = [0] + [m.end() for m in re.finditer(" ", words)]
    found: list[tuple] = []
    for keyword in sorted(set(keywords)):
        for label, priority, confidence, pattern in compiled.get(keyword, ()):
            for m in pattern.finditer(words):
                if m.end() == m.start():
                    continue
                first = bisect.bisect_right(starts, m.start()) - 1
                last = bisect.bisect_right(starts, m.end() - 1) - 1
                found.append((first, last + 1, priority, confidence, label))
    found = sorted(set(found))
    firsts = [d[0] for d in found]
    kept = []
    for d in found:
        # A container starts at most LONGEST words before: only those are looked at.
        near = found[bisect.bisect_left(firsts, d[0] - LONGEST) : bisect.bisect_right(firsts, d[0])]
        if not any(_beats(o, d) for o in near):
            kept.append(d)
    return [dict(label=d[4], start=d[0], end=d[1], priority=d[2], confidence=d[3]) for d in kept]


def _beats(other: tuple, mine: tuple) -> bool:
    """Whether ``other`` contains ``mine`` and outranks it."""
    if other == mine or not (other[0] <= mine[0] and mine[1] <= other[1]):
        return False
    return other[2] > mine[2] or (other[2] == mine[2] and other[1] - other[0] > mine[1] - mine[0])


_DETECTIONS = T.ArrayType(
    T.StructType(
        [
            T.StructField("label", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("priority", T.IntegerType()),
            T.StructField("confidence", T.DoubleType()),
        ]
    )
)


@F.pandas_udf(_DETECTIONS)
def _detections(words: pd.Series, keywords: pd.Series) -> pd.Series:
    return pd.Series(
        [[] if w is None else detect(w, list(k) if k is not None else []) for w, k in zip(words, keywords)]
    )


def keywords(rules: Sequence[tuple] = RULES) -> list[str]:
    return sorted({rule[3] for rule in rules})


def scan(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add word counts, base places and labels, the method's detections and labels, and a score."""
    documents = without(documents, *RESULT)
    words = normalised(F.col(text))
    staged = documents.withColumn("__words", words)
    w = F.col("__words")
    places = [(label, base_places(w, phrase)) for phrase, label in BASE_PHRASES]
    all_places = F.flatten(F.array(*[p for _, p in places]))
    base = F.array_sort(F.array_distinct(F.filter(F.array(*[F.when(F.size(p) > 0, F.lit(l)) for l, p in places]), lambda x: x.isNotNull())))
    found = F.array_intersect(F.array_distinct(w), F.array(*[F.lit(k) for k in keywords()]))
    gated = F.when(F.size("__found") > 0, F.array_join(w, " "))
    staged = (
        staged.withColumn("__places", all_places)
        .withColumn("__base", base)
        .withColumn("__found", found)
        .withColumn("detections", _detections(gated, F.col("__found")))
    )
    method = F.transform("detections", lambda d: d["label"])
    labels = F.array_sort(F.array_distinct(F.concat("__base", method)))
    miss = F.aggregate(F.transform("detections", lambda d: F.lit(1.0) - d["confidence"]), F.lit(1.0), lambda a, x: a * x)
    miss = miss * F.pow(F.lit(1.0 - BASE_CONFIDENCE), F.size("__places"))
    return staged.select(
        *[F.col(c) for c in documents.columns],
        F.size(w).cast("long").alias("n_words"),
        F.size("__places").cast("long").alias("n_base"),
        F.array_min("__places").cast("long").alias("first_word"),
        F.array_max("__places").cast("long").alias("last_word"),
        F.array_join("__base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        (F.lit(1.0) - miss).alias("score"),
        "detections",
    )
