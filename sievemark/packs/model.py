"""The in-memory form of a rule pack and its rules-table form."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.packs import lexicons

logger = logging.getLogger(__name__)

RULES_SCHEMA = "pack string, category string, lang string, kind string, ord int, pattern string"

# A pack becomes column expressions on the driver; larger ones are refused unless asked for.
MAX_RULES = 20_000


@dataclass(frozen=True)
class Category:
    """One sensitive category.

    ``rules`` are whole regexes; ``entities``, ``verify_entities``, ``safe`` and
    ``hard`` are word lists matched as whole words. A category with
    ``verify_entities`` gets the verification layer.
    """

    name: str
    rules: tuple[str, ...] = ()
    entities: tuple[str, ...] = ()
    score_label: str | None = None
    verify_entities: tuple[str, ...] = ()
    safe: tuple[str, ...] = ()
    hard: tuple[str, ...] = ()

    @property
    def verified(self) -> bool:
        return bool(self.verify_entities)


@dataclass(frozen=True)
class RulePack:
    """Explicit rule lists by language, categories, and shared word lists."""

    explicit: tuple[tuple[str, tuple[str, ...]], ...] = ()
    categories: tuple[Category, ...] = ()
    amplifiers: tuple[str, ...] = ()
    toxic_labels: tuple[str, ...] = lexicons.TOXIC_LABELS
    safe_label: str = lexicons.SAFE_LABEL
    max_rules: int = MAX_RULES

    def __post_init__(self) -> None:
        if len({c.name for c in self.categories}) != len(self.categories):
            raise ValueError("category names must be unique")
        if sum(c.verified for c in self.categories) > 1:
            raise ValueError("at most one category can be verified")
        if self.size() > self.max_rules:
            raise ValueError(f"a pack holds at most {self.max_rules} rules, got {self.size()}; see max_rules")
        for c in self.categories:
            if c.verified and not c.hard:
                logger.warning("category %s is verified without hard words: context alone decides", c.name)

    def size(self) -> int:
        return len(self._rows(""))

    @property
    def verified(self) -> Category | None:
        return next((c for c in self.categories if c.verified), None)

    def category(self, name: str) -> Category:
        return next(c for c in self.categories if c.name == name)

    def with_explicit(self, lang: str, rules: tuple[str, ...]) -> RulePack:
        return replace(self, explicit=(*self.explicit, (lang, tuple(rules))))

    def _rows(self, pack: str) -> list[tuple]:
        groups = [(None, lang, "rule", rules) for lang, rules in self.explicit]
        for c in self.categories:
            groups += [
                (c.name, None, "rule", c.rules),
                (c.name, None, "entity", c.entities),
                (c.name, None, "verify_entity", c.verify_entities),
                (c.name, None, "safe", c.safe),
                (c.name, None, "hard", c.hard),
                (c.name, None, "score_label", (c.score_label,) if c.score_label else ()),
            ]
        groups.append((None, None, "amplifier", self.amplifiers))
        return [
            (pack, category, lang, kind, i, pattern)
            for category, lang, kind, patterns in groups
            for i, pattern in enumerate(patterns)
        ]

    def to_df(self, spark: SparkSession, pack: str = "default") -> DataFrame:
        """The pack as a ``rules`` table."""
        return spark.createDataFrame(self._rows(pack), RULES_SCHEMA)

    @classmethod
    def from_df(
        cls, rules: DataFrame, pack: str | None = None, order: Sequence[str] = (), max_rules: int = MAX_RULES
    ) -> RulePack:
        """Build a pack from a ``rules`` table.

        A table of several packs needs ``pack``, and no place in a list may be taken
        twice: otherwise rules would be lost.

        Categories and languages named in ``order`` come first, in that order;
        others follow as they are met.

        One row more than the bound is fetched, so an oversized table is
        refused instead of being read whole or cut short.
        """
        if pack is not None:
            rules = rules.where(F.col("pack") == pack)
        rows = rules.select("pack", "category", "lang", "kind", "ord", "pattern").limit(max_rules + 1).collect()
        if len(rows) > max_rules:
            raise ValueError(f"a pack holds at most {max_rules} rules; see max_rules")
        packs = {r["pack"] for r in rows}
        if len(packs) > 1:
            raise ValueError(f"the table holds several packs, name one of {sorted(map(str, packs))}")
        places = Counter((r.category, r.lang, r.kind, r["ord"]) for r in rows)
        if repeated := [place for place, n in places.items() if n > 1]:
            raise ValueError(f"rules share a place in their list: {repeated[:5]}")
        rank = {name: i for i, name in enumerate(order)}
        rows.sort(key=lambda r: rank.get(r.category if r.category is not None else r.lang, len(rank)))
        explicit: dict[str, dict[int, str]] = {}
        categories: dict[str, dict[str, dict[int, str]]] = {}
        amplifiers: dict[int, str] = {}
        for row in rows:
            if row.category is not None:
                categories.setdefault(row.category, {}).setdefault(row.kind, {})[row.ord] = row.pattern
            elif row.kind == "amplifier":
                amplifiers[row.ord] = row.pattern
            else:
                explicit.setdefault(row.lang, {})[row.ord] = row.pattern

        def ordered(patterns: dict[int, str] | None) -> tuple[str, ...]:
            return tuple(p for _, p in sorted((patterns or {}).items()))

        return cls(
            explicit=tuple((lang, ordered(patterns)) for lang, patterns in explicit.items()),
            categories=tuple(
                Category(
                    name,
                    rules=ordered(kinds.get("rule")),
                    entities=ordered(kinds.get("entity")),
                    score_label=next(iter(ordered(kinds.get("score_label"))), None),
                    verify_entities=ordered(kinds.get("verify_entity")),
                    safe=ordered(kinds.get("safe")),
                    hard=ordered(kinds.get("hard")),
                )
                for name, kinds in categories.items()
            ),
            amplifiers=ordered(amplifiers),
            max_rules=max_rules,
        )
