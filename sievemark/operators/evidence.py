"""Which rules are found in a text, and with what wording."""

from __future__ import annotations

import json
import zlib
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.regex import (
    begun_by,
    folded,
    jvm_pattern,
    literal_hits,
    literal_of,
    looser_pattern,
    never_empty,
    scan_pattern,
    word_hits,
)
from sievemark.functions.text import STRINGS, empty_strings

# So many rules that are no literals are scanned for in every text; of more, each text
# is first asked which it can hold.
FEW = 6

_PREFIX = "__evidence_"
_HITS, _FOUND, _KEYS, _WORDING, _POSSIBLE, _SCANNED = (
    _PREFIX + name for name in ("hits", "found", "keys", "wording", "possible", "scanned")
)
_ENTRIES = "array<struct<ord:int,match:string>>"


def with_evidence(
    df: DataFrame,
    lists: Mapping[str, Sequence[str]],
    text: Column,
    guard: Column | None = None,
    positions: bool = False,
    words: Sequence[str] = (),
    words_column: str | None = None,
) -> DataFrame:
    """Add one column per rule list: the evidence its rules find in ``text``.

    There is one entry per rule found, in rule order: its first match in
    original case. Overlapping rules all count. With ``positions`` an entry is
    ``struct<ord, match>``. Texts outside ``guard`` get empty lists unread.

    Literal rules of all lists are found together, in one pass over the text;
    what is left to do is a lookup of the few words found. Each other rule is looked
    for by one scan, in the texts that can hold it. Further literal ``words`` are looked for in the
    same pass; ``words_column`` receives each distinct wording found of any
    literal.
    """
    guard = F.lit(True) if guard is None else guard
    rules = [rule for patterns in lists.values() for rule in patterns]
    literals = [*words, *(literal for literal in map(literal_of, rules) if literal is not None)]
    others = [rule for rule in rules if literal_of(rule) is None]
    before = df.columns
    df = _with_literals_found(df, literals, text, guard, words_column)
    if others:
        df = _with_scanned(df, others, text, guard)
    columns, start = {}, 0
    for name, patterns in lists.items():
        columns[name] = _list_evidence(patterns, positions, start)
        start += sum(literal_of(rule) is None for rule in patterns)
    kept = [*before, *([words_column] if words_column else []), *columns]
    return df.withColumns(columns).select(*kept)


def _with_literals_found(
    df: DataFrame, literals: Sequence[str], text: Column, guard: Column, words_column: str | None
) -> DataFrame:
    """Add the distinct literals found, and the first wording of each."""
    if not literals:
        return df.withColumns({_KEYS: empty_strings(), _WORDING: empty_strings()})
    hits = F.when(guard, literal_hits(text, literals)).otherwise(empty_strings())
    df = df.withColumn(_HITS, hits)
    beginnings = begun_by(literals)
    if beginnings:
        # A long hit is also a hit of each literal it begins with.
        lengths = F.from_json(F.lit(json.dumps(beginnings)), "map<string,array<int>>")

        def with_beginnings(hit: Column) -> Column:
            shorter = F.transform(lengths[folded(hit)], lambda n: F.substring(hit, F.lit(1), n))
            return F.coalesce(F.array_prepend(shorter, hit), F.array(hit))

        df = df.withColumn(_HITS, F.flatten(F.transform(_HITS, with_beginnings)))
    df = df.withColumn(_FOUND, F.transform(_HITS, folded))
    first_wordings = F.transform(
        F.array_distinct(_FOUND), lambda key: F.get(_HITS, _index(F.array_position(_FOUND, key)))
    )
    found = {_KEYS: F.array_distinct(_FOUND), _WORDING: first_wordings}
    if words_column:
        found[words_column] = F.array_distinct(_HITS)
    return df.withColumns(found)


def _index(position: Column) -> Column:
    return position.cast("int") - 1


def _entry(position: Column, match: Column, positions: bool) -> Column:
    return F.struct(position.cast("int").alias("ord"), match.alias("match")) if positions else match


def _list_evidence(rules: Sequence[str], positions: bool, start: int) -> Column:
    """Entries of one list in rule order. ``start`` is the place of its first non-literal
    rule among those of all lists."""
    places: dict[bool, list[int]] = {True: [], False: []}
    for i, rule in enumerate(rules):
        places[literal_of(rule) is not None].append(i)
    parts = []
    if places[True]:
        parts.append(_literal_entries([literal_of(rules[i]) for i in places[True]], places[True]))
    if places[False]:
        own = F.filter(_SCANNED, lambda hit: (hit["ord"] >= start) & (hit["ord"] < start + len(places[False])))
        at = _constants(places[False])
        parts.append(F.transform(own, lambda hit: _entry(F.get(at, hit["ord"] - start), hit["match"], True)))
    if not parts:
        return F.array().cast(_ENTRIES if positions else STRINGS)
    # Literals come in the order they were found in.
    entries = F.sort_array(F.concat(*parts)) if places[True] else parts[0]
    return entries if positions else F.transform(entries, lambda entry: entry["match"])


def _constants(numbers: Sequence[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<int>")


def _literal_entries(literals: Sequence[str], places: Sequence[int]) -> Column:
    # Constant buckets of literals by checksum: the few words found are looked up, not each literal.
    buckets: list[list[dict]] = [[] for _ in literals]
    for literal, place in zip(literals, places):
        buckets[zlib.crc32(literal.encode()) % len(buckets)].append({"literal": literal, "ord": place})
    known = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<literal:string,ord:int>>>")

    def look_up(key: Column, i: Column) -> Column:
        bucket = F.get(known, (F.crc32(key.cast("binary")) % len(buckets)).cast("int"))
        return F.transform(
            F.filter(bucket, lambda rule: rule["literal"] == key),
            lambda rule: _entry(rule["ord"], F.get(_WORDING, i), True),
        )

    found = F.flatten(F.transform(_KEYS, look_up))
    return F.when(F.size(_KEYS) > 0, found).otherwise(F.array().cast(_ENTRIES))


def possible_rules(text: Column, rules: Sequence[str]) -> Column:
    """Places of the rules that ``text`` can hold: all that it holds and few more.

    Rules are looked for by looser patterns in Arrow's linear-time engine; one that has
    none is always possible. What a text does hold is for the rules themselves to say.
    """
    patterns = [looser_pattern(rule) for rule in rules]

    def run(texts: pa.Array) -> pa.Array:
        hits = np.ones((len(texts), len(patterns)), dtype=bool)
        for i, pattern in enumerate(patterns):
            if pattern is not None:
                found = pc.fill_null(pc.match_substring_regex(texts, pattern), False)
                hits[:, i] = found.to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(hits.sum(axis=1))])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.nonzero(hits)[1], pa.int32()))

    return F.arrow_udf(run, "array<int>")(F.make_valid_utf8(text))


def _with_scanned(df: DataFrame, rules: Sequence[str], text: Column, guard: Column) -> DataFrame:
    """Add ``struct<ord, match>`` of each rule found, in rule order: its first match."""
    many = len(rules) > FEW
    if many:
        df = df.withColumn(_POSSIBLE, possible_rules(F.when(guard, text), rules))
    matches = []
    for i, rule in enumerate(rules):
        match = F.regexp_extract(text, scan_pattern(rule), 0)
        # An empty string means no match only where a match covers text.
        tests = [] if never_empty(rule) else [text.rlike(jvm_pattern(rule))]
        for test in [*tests, *([F.array_contains(_POSSIBLE, i)] if many else [])]:
            match = F.when(test, match)
        matches.append(match)
    covering = F.array(*[F.lit(never_empty(rule)) for rule in rules])
    entries = F.transform(F.array(*matches), lambda match, i: _entry(i, match, True))
    found = F.filter(entries, lambda e: e["match"].isNotNull() & ((e["match"] != "") | ~F.get(covering, e["ord"])))
    return df.withColumn(_SCANNED, F.when(guard, found).otherwise(F.array().cast(_ENTRIES)))


def language(evidence: Mapping[str, Column]) -> Column:
    """The list that hit, ``both`` if several did, else ``unknown``."""
    hits = {lang: F.size(found) > 0 for lang, found in evidence.items()}
    lists_hit = sum((h.cast("int") for h in hits.values()), F.lit(0))
    verdict = F.when(lists_hit > 1, F.lit("both"))
    for lang, hit in hits.items():
        verdict = verdict.when(hit, F.lit(lang))
    return verdict.otherwise(F.lit("unknown"))


def entity_hits(text: Column, entities: Sequence[str]) -> Column:
    """All entity words in text order, repeats included."""
    if not entities:
        return empty_strings()
    return word_hits(text, entities).cast(STRINGS)
