"""Neutral packs for the generated test tables (no real offensive wording)."""

from __future__ import annotations

from itertools import product

from sievemark.packs.model import Category, RulePack

NEUTRAL = RulePack(
    explicit=(
        ("en", (r"\bidiot\b", r"\bmoron\b", r"\bclown\b", r"\bthis with\b")),
        ("de", (r"\bder und\b", r"\bidiot\b", r"\bpathetic\b")),
    ),
    categories=(
        Category(
            "alpha",
            rules=(r"\bscum\b", r"\bfor.{0,10}trash\b", r"\bof the\b"),
            entities=("from", "with", "for"),
            score_label="alpha",
            verify_entities=("from", "with", "for"),
            safe=("was", "have", "not", "you"),
            hard=("scum", "for trash"),
        ),
        Category(
            "beta",
            rules=(r"\bworthless\b", r"\bthis.?is\b"),
            entities=("that", "this"),
            score_label="beta",
        ),
        Category(
            "gamma",
            rules=(r"\bpathetic\b", r"\bby.*loser\b"),
            entities=("this", "with"),
            score_label="gamma",
        ),
    ),
    amplifiers=("idiot", "clown", "moron", "trash", "stupid", "disgusting", "loser"),
    safe_label="safe",
)

# Word parts of the generated English prose; every ordered pair becomes a rule.
_PARTS = "th er ti on re an ing ed st ou nd ha at en es or nt ea it is hi sh ly ble".split()


def wide_rules() -> tuple[str, ...]:
    """A rule list as long as a production pack (576 rules)."""
    return tuple(rf"\b{a}{b}\b" for a, b in product(_PARTS, _PARTS))


def mixed_rules() -> tuple[str, ...]:
    """The same list with one rule in 14 that is no literal, of four kinds by turns."""
    rules = []
    for i, (a, b) in enumerate(product(_PARTS, _PARTS)):
        kinds = (rf"\b{a}.?{b}\b", rf"\b{a}.{{0,20}}{b}\b", rf"\b{a}.*{b}\b", rf"\b[{a[0]}x]{a[1:]}{b}\b")
        rules.append(kinds[i // 14 % 4] if i % 14 == 13 else rf"\b{a}{b}\b")
    return tuple(rules)


WIDE = RulePack(explicit=(("en", wide_rules()),))
MIXED = RulePack(explicit=(("en", mixed_rules()),))
