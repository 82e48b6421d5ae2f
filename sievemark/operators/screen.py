"""From documents to decisions: ``explicit``, ``sensitive`` and ``keep``."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.plans import settled
from sievemark.functions.regex import any_rule, independent_words
from sievemark.functions.text import digits_as_letters, empty_strings, original_wording
from sievemark.operators import verify
from sievemark.operators.evidence import entity_hits, language, with_evidence
from sievemark.operators.proximity import boosted, targeted, whole_words
from sievemark.operators.scores import CATEGORY_SCORES, CATEGORY_TYPE, EXPLICIT_SCORE, flagged_by_score
from sievemark.packs import Category, RulePack


@dataclass(frozen=True)
class ScreenConfig:
    """Parameters of a run. Workers, batch size and devices are Spark's business."""

    use_ml: bool = False
    ml_threshold: float = 0.70
    keyword_threshold: int = 1
    skip_explicit: bool = False
    skip_categories: bool = False
    write_cleaned: bool = True
    context_window: int = 80
    target_window: int = 40
    boost_evidence: int = 3
    #: Read 0, 1, 3 and 4 inside lettered words as o, i, e and a before matching.
    digit_spellings: bool = False

    def __post_init__(self) -> None:
        if self.keyword_threshold < 1:
            raise ValueError("keyword_threshold must be at least 1")


_PREFIX = "__screen_"


def _name(*parts: str) -> str:
    return _PREFIX + "_".join(parts)


def _col(*parts: str) -> Column:
    return F.col(_name(*parts))


def _explicit_result(pack: RulePack, config: ScreenConfig, score: Column | None) -> Column:
    evidence = {lang: _col("explicit", lang) for lang, _ in pack.explicit}
    matched = F.concat(empty_strings(), *evidence.values())
    flagged = F.size(matched) >= config.keyword_threshold
    if score is not None:
        flagged = flagged | flagged_by_score(score, pack, config.ml_threshold)
    return F.struct(
        flagged.alias("is_explicit"),
        language(evidence).alias("language"),
        matched.alias("matched_keywords"),
        (score["score"] if score is not None else F.lit(None)).cast("double").alias("ml_score"),
        (F.upper(score["label"]) if score is not None else F.lit(None)).cast("string").alias("ml_label"),
    )


def _category_stages(
    df: DataFrame, pack: RulePack, config: ScreenConfig, scores: Column | None
) -> DataFrame:
    """One projection per dependency level; each intermediate is computed once."""
    text, hit, low = _col("text"), _col("hit"), _col("low")
    amplifiers = pack.amplifiers

    def by_score(label: str | None) -> Column:
        if scores is None or label is None:
            return F.lit(False)
        return F.coalesce(scores[label] >= config.ml_threshold, F.lit(False))

    def enough(name: str) -> Column:
        return F.size(_col("rules", name)) >= config.keyword_threshold

    def near_insult(category: Category) -> Column:
        if not (amplifiers and category.entities):
            return F.lit(False)
        words = independent_words(category.entities)
        if words is None:
            found = entity_hits(text, category.entities)
            near = boosted(text, low, found, amplifiers, config.context_window)
        else:
            near = boosted(text, low, _col("words"), amplifiers, config.context_window, words)
        return hit & ~enough(category.name) & near

    read_lower = hit | (by_score(pack.verified.score_label) if pack.verified else F.lit(False))
    df = df.withColumn(_name("low"), F.when(read_lower, F.lower(text)))
    df = df.withColumns({_name("boost", c.name): near_insult(c) for c in pack.categories})
    df = df.withColumns(
        {
            _name("raised", c.name): enough(c.name) | _col("boost", c.name) | by_score(c.score_label)
            for c in pack.categories
        }
        | {
            _name("matches", c.name): F.when(
                _col("boost", c.name),
                F.concat(
                    _col("rules", c.name), F.slice(entity_hits(text, c.entities), 1, config.boost_evidence)
                ),
            ).otherwise(_col("rules", c.name))
            for c in pack.categories
        }
    )
    checked = pack.verified
    if checked is None:
        return df
    raised, hard, safe, insults = (_col(c) for c in (f"raised_{checked.name}", "hard", "safe", "insults"))
    df = df.withColumn(_name("hard"), raised & verify.hard_hit(low, checked))
    open_case = raised & ~hard
    df = df.withColumns(
        {
            _name("safe"): F.when(open_case, verify.word_count(low, checked.safe)).otherwise(0),
            _name("insults"): F.when(open_case, verify.word_count(low, pack.amplifiers)).otherwise(0),
        }
    )
    at_entity = targeted(low, checked.verify_entities, amplifiers, config.target_window)
    df = df.withColumn(
        _name("targeted"),
        open_case & ~verify.rescued_by_words(safe, insults) & at_entity,
    )
    return df.withColumn(
        _name("verdict"),
        F.when(
            raised,
            verify.verdict(
                checked, pack, hard, safe, insults, _col("targeted"), scores, config.ml_threshold
            ),
        ),
    )


def _category_result(pack: RulePack, scores: Column | None) -> Column:
    checked = pack.verified
    flags = {
        c.name: _col("raised", c.name) & F.coalesce(_col("verdict")["confirmed"], F.lit(False))
        if c is checked
        else _col("raised", c.name)
        for c in pack.categories
    }
    any_flag = F.lit(False)
    for flag in flags.values():
        any_flag = any_flag | flag
    verified = (
        [
            _col("verdict")["confirmed"].alias(f"{checked.name}_verified"),
            F.coalesce(_col("verdict")["reason"], F.lit("")).alias("verification_reason"),
        ]
        if checked
        else []
    )
    no_scores = F.map_from_arrays(empty_strings(), F.array().cast("array<double>"))
    return F.struct(
        any_flag.alias("is_sensitive"),
        category_list(flags).alias("categories"),
        *[flag.alias(f"{name}_flagged") for name, flag in flags.items()],
        *[_col("matches", name).alias(f"{name}_matches") for name in flags],
        (F.coalesce(scores, no_scores) if scores is not None else no_scores)
        .cast(CATEGORY_TYPE)
        .alias("ml_scores"),
        *verified,
    )


def category_list(flags: dict[str, Column]) -> Column:
    """Upper-case names of the raised categories, in pack order."""
    return F.array_compact(F.array(*[F.when(flag, F.lit(name.upper())) for name, flag in flags.items()]))


def screen(
    documents: DataFrame,
    pack: RulePack,
    config: ScreenConfig = ScreenConfig(),
    text: str = "text",
) -> DataFrame:
    """Add ``explicit``, ``sensitive`` (unless skipped) and ``keep`` to documents.

    Only column expressions: no shuffle, the same on streams, and a Python worker (Arrow) only
    for a pack with more than ``evidence.FEW`` rules that are no literals.
    Most texts are settled by the first scan, which looks for any rule or entity
    at once. With ``config.use_ml`` the columns ``explicit_score`` and
    ``category_scores`` are used where present.
    """
    explicit_score = F.col(EXPLICIT_SCORE) if config.use_ml and EXPLICIT_SCORE in documents.columns else None
    category_scores = F.col(CATEGORY_SCORES) if config.use_ml and CATEGORY_SCORES in documents.columns else None
    lists: dict[str, tuple[str, ...]] = {}
    entities: list[str] = []
    if not config.skip_explicit:
        lists |= {_name("explicit", lang): rules for lang, rules in pack.explicit}
    if not config.skip_categories:
        lists |= {_name("rules", c.name): c.rules for c in pack.categories}
        entities += [e for c in pack.categories for e in c.entities]
    rules = [rule for patterns in lists.values() for rule in patterns]
    words = [w for c in pack.categories if entities for w in independent_words(c.entities) or ()]
    source = F.coalesce(F.col(text), F.lit(""))
    # Digit spellings: rules read a shadow text of equal length, so places and windows stay.
    df = documents.withColumn(_name("text"), digits_as_letters(source) if config.digit_spellings else source)
    df = df.withColumn(_name("hit"), any_rule(_col("text"), rules + whole_words(entities)))
    df = with_evidence(
        df, lists, _col("text"), guard=_col("hit"), words=words, words_column=_name("words") if words else None
    )
    results: dict[str, Column] = {}
    flagged = F.lit(False)
    if not config.skip_explicit:
        results["explicit"] = _explicit_result(pack, config, explicit_score)
    if not config.skip_categories:
        df = _category_stages(df, pack, config, category_scores)
        results["sensitive"] = _category_result(pack, category_scores)
    df = df.withColumns({_name(name): column for name, column in results.items()})
    if config.digit_spellings:
        df = _written_as_found(df, pack, source, list(results))
    if "explicit" in results:
        flagged = flagged | _col("explicit")["is_explicit"]
    if "sensitive" in results:
        flagged = flagged | _col("sensitive")["is_sensitive"]
    decisions = {name: _col(name) for name in results} | {"keep": ~flagged}
    return settled(df, [c for c in documents.columns if c not in decisions], decisions)


def _written_as_found(df: DataFrame, pack: RulePack, source: Column, done: list[str]) -> DataFrame:
    """Evidence in the wording of the text itself, not of its shadow."""

    def back(found: Column) -> Column:
        return F.transform(found, lambda w: original_wording(source, w))

    if "explicit" in done:
        explicit = _col("explicit")
        df = df.withColumn(_name("explicit"), explicit.withField("matched_keywords", back(explicit["matched_keywords"])))
    if "sensitive" in done:
        sensitive = _col("sensitive")
        for c in pack.categories:
            sensitive = sensitive.withField(f"{c.name}_matches", back(_col("sensitive")[f"{c.name}_matches"]))
        df = df.withColumn(_name("sensitive"), sensitive)
    return df


def screen_explicit(
    documents: DataFrame, pack: RulePack, config: ScreenConfig = ScreenConfig(), text: str = "text"
) -> DataFrame:
    """Only the explicit check."""
    return screen(documents, pack, replace(config, skip_explicit=False, skip_categories=True), text)


def screen_categories(
    documents: DataFrame, pack: RulePack, config: ScreenConfig = ScreenConfig(), text: str = "text"
) -> DataFrame:
    """Only the sensitive categories."""
    return screen(documents, pack, replace(config, skip_explicit=True, skip_categories=False), text)
