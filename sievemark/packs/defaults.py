"""A pack for the default three categories around the user's own rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from sievemark.packs import lexicons
from sievemark.packs.model import Category, RulePack


def three_category_pack(
    explicit: Mapping[str, Sequence[str]],
    race: Sequence[str] = (),
    religion: Sequence[str] = (),
    royalty: Sequence[str] = (),
    hard: Sequence[str] = (),
) -> RulePack:
    """Explicit lists by language plus race (verified), religion and royalty."""
    return RulePack(
        explicit=tuple((lang, tuple(rules)) for lang, rules in explicit.items()),
        categories=(
            Category(
                "race",
                rules=tuple(race),
                entities=lexicons.RACE_ENTITIES,
                score_label=lexicons.RACE_LABEL,
                verify_entities=lexicons.RACE_VERIFY_ENTITIES,
                safe=lexicons.SAFE_CONTEXT,
                hard=tuple(hard),
            ),
            Category(
                "religion",
                rules=tuple(religion),
                entities=lexicons.RELIGION_ENTITIES,
                score_label=lexicons.RELIGION_LABEL,
            ),
            Category(
                "royalty",
                rules=tuple(royalty),
                entities=lexicons.ROYALTY_ENTITIES,
                score_label=lexicons.ROYALTY_LABEL,
            ),
        ),
        amplifiers=lexicons.AMPLIFIERS,
    )
