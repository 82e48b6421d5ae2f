"""Second look at a flagged category: confirm it, or rescue harmless context."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sievemark.functions.regex import any_rule, word_hits
from sievemark.operators.proximity import whole_words
from sievemark.packs import Category, RulePack

# Enough safe words to rescue, and insults tolerated with them.
SAFE_ENOUGH = 2
INSULTS_TOLERATED = 1


def _two_places(score: Column) -> Column:
    return F.format_number(score, 2)


def hard_hit(lowered: Column, category: Category) -> Column:
    return any_rule(lowered, whole_words(category.hard))


def word_count(lowered: Column, terms: tuple[str, ...]) -> Column:
    """Number of non-overlapping lexicon words."""
    if not terms:
        return F.lit(0)
    return F.size(word_hits(lowered, terms))


def rescued_by_words(safe: Column, insults: Column) -> Column:
    """Safe words alone settle it."""
    return ((safe >= SAFE_ENOUGH) & (insults <= INSULTS_TOLERATED)) | ((safe > 0) & (safe > insults))


def verdict(
    category: Category,
    pack: RulePack,
    hard: Column,
    safe: Column,
    insults: Column,
    is_targeted: Column,
    scores: Column | None,
    threshold: float,
) -> Column:
    """``struct<confirmed, reason>``; the first rule that applies wins."""

    def outcome(confirmed: bool, *reason: Column | str) -> Column:
        parts = [r if isinstance(r, Column) else F.lit(r) for r in reason]
        return F.struct(F.lit(confirmed).alias("confirmed"), F.concat(*parts).alias("reason"))

    safe_text, insults_text = safe.cast("string"), insults.cast("string")
    # The wording of the reasons.
    decision = (
        F.when(hard, outcome(True, "hard_slur"))
        .when(
            (safe >= SAFE_ENOUGH) & (insults <= INSULTS_TOLERATED),
            outcome(
                False,
                "safe_context(",
                safe_text,
                f"≥{SAFE_ENOUGH},insults=",
                insults_text,
                f"≤{INSULTS_TOLERATED})",
            ),
        )
        .when(
            (safe > 0) & (safe > insults),
            outcome(False, "safe_dominates(", safe_text, ">", insults_text, ")"),
        )
        .when(~is_targeted & (safe > 0), outcome(False, "insult_not_targeted_at_entity"))
    )
    if scores is not None:
        against = F.coalesce(scores[category.score_label], F.lit(0.0))
        harmless = F.coalesce(scores[pack.safe_label], F.lit(0.0))
        decision = decision.when(
            (harmless > against) & (against < threshold),
            outcome(False, "ml_safe(", _two_places(harmless), ">", _two_places(against), ")"),
        ).when(against >= threshold, outcome(True, "ml_confirmed(racial=", _two_places(against), ")"))
    return decision.when(is_targeted, outcome(True, "targeted_insult")).otherwise(
        outcome(True, "keyword_match")
    )
