"""Insult words close to an entity: the boost and the targeting test.

The two look alike and differ on purpose. The boost looks once per distinct
wording, around the first place where it occurs even inside another word; the
targeting test looks around every whole-word occurrence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievemark.functions.regex import FLAGS, any_rule, folded, word_list_body


def whole_words(terms: Sequence[str]) -> list[str]:
    """Each lexicon term as a rule of its own."""
    return [rf"\b(?:{t})\b" if "|" in t else rf"\b{t}\b" for t in terms]


def boosted(
    text: Column,
    lowered: Column,
    hits: Column,
    amplifiers: Sequence[str],
    window: int,
    entities: Sequence[str] | None = None,
) -> Column:
    """An amplifier lies within ``window`` characters of a hit's first place.

    With ``entities`` (literal words), only hits that are one of them count.
    """
    hits = F.array_distinct(hits)
    if entities is not None:
        wanted = F.split(F.lit("\n".join(entities)), "\n")
        hits = F.filter(hits, lambda hit: F.array_contains(wanted, folded(hit)))
    places = F.transform(
        hits, lambda hit: F.struct(F.position(F.lower(hit), lowered).alias("at"), F.length(hit).alias("size"))
    )

    def near(place: Column) -> Column:
        start = F.greatest(place["at"] - window, F.lit(1))
        snippet = F.substring(text, start, place["at"] + place["size"] + window - start)
        return (place["at"] > 0) & any_rule(snippet, whole_words(amplifiers))

    return F.exists(places, near)


def targeted(lowered: Column, entities: Sequence[str], amplifiers: Sequence[str], window: int) -> Column:
    """An amplifier lies within ``window`` characters of some entity occurrence.

    Both windows are captured by lookarounds while the entities are matched one
    after the other. The left part may be ``2 * window`` code units long, as
    rare characters take two, and is cut to ``window`` characters afterwards.
    """
    if not (entities and amplifiers):
        return F.lit(False)
    entity = word_list_body(entities)
    before = rf"(?<=(\A.{{0,{2 * window}}}|.{{{window},{2 * window}}}))"
    pattern = f"{FLAGS}(?s)(?={entity}){before}{entity}(?=(.{{0,{window}}}))"
    with_word = f"{FLAGS}(?s)(?=({entity}.{{0,{window}}})){entity}"
    left = F.regexp_extract_all(lowered, F.lit(pattern), F.lit(1))
    right = F.regexp_extract_all(lowered, F.lit(with_word), F.lit(1))
    windows = F.zip_with(left, right, lambda a, b: F.concat(F.right(a, F.lit(window)), b))
    return F.exists(windows, lambda w: any_rule(w, whole_words(amplifiers)))
