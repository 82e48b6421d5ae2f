"""Rule files: UTF-8 text, one regex per line, ``#`` starts a comment line."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.functions.regex import jvm_pattern, repetition_risk, word_list_rule
from sievemark.functions.text import strip
from sievemark.packs.defaults import three_category_pack
from sievemark.packs.model import MAX_RULES, RULES_SCHEMA, RulePack
from sievemark.sources.numbering import located, numbered

logger = logging.getLogger(__name__)

REJECTED_SCHEMA = RULES_SCHEMA + ", reason string"


@dataclass(frozen=True)
class RuleFile:
    """Where a list comes from and what it is for."""

    path: str
    kind: str = "rule"
    category: str | None = None
    lang: str | None = None


def read_rule_lines(spark: SparkSession, path: str, max_rules: int = MAX_RULES) -> list[str]:
    """The rules of a file in file order, or of a folder's files in path order.

    A missing file gives an empty list. ``max_rules`` bounds what is brought to the
    driver; more is an error, never a cut.
    """
    try:
        scan = spark.read.text(path)
    except AnalysisException:
        logger.warning("rule file not found: %s", path)
        return []
    lines = numbered(located(scan.select("value", "_metadata")).drop("_metadata"), across_files=True)
    rules = lines.select("line_no", strip(F.col("value")).alias("rule")).where(
        (F.col("rule") != "") & ~F.col("rule").startswith("#")
    )
    rows = rules.limit(max_rules + 1).collect()
    if len(rows) > max_rules:
        raise ValueError(f"{path} holds more than {max_rules} rules; see max_rules")
    return [r.rule for r in sorted(rows, key=lambda r: r.line_no)]


def _jvm_accepts(spark: SparkSession, rules: Sequence[str]) -> bool:
    probes = [F.lit("").rlike(jvm_pattern(r)).alias(f"c{i}") for i, r in enumerate(rules)]
    try:
        spark.range(1).select(*probes).collect()
    except Exception:  # the engine reports a bad pattern in more than one way
        return False
    return True


def _jvm_rejects(spark: SparkSession, rules: Sequence[str]) -> set[int]:
    """Positions of rules the engine cannot compile, by halving failing batches."""
    pending, bad = [range(len(rules))], set()
    while pending:
        batch = pending.pop()
        if not batch or _jvm_accepts(spark, [rules[i] for i in batch]):
            continue
        if len(batch) == 1:
            bad.add(batch[0])
        else:
            middle = len(batch) // 2
            pending += [batch[:middle], batch[middle:]]
    return bad


def check_rules(spark: SparkSession, rules: Sequence[str]) -> Mapping[int, str]:
    """Reasons by position for the rules that cannot be used."""
    reasons: dict[int, str] = {}
    for i, rule in enumerate(rules):
        try:
            re.compile(rule)
        except re.error as error:
            reasons[i] = f"invalid regex: {error}"
            continue
        risk = repetition_risk(rule)
        if risk:
            reasons[i] = f"may exhaust the matching engine's stack: {risk}"
    valid = [i for i in range(len(rules)) if i not in reasons]
    for position in _jvm_rejects(spark, [rules[i] for i in valid]):
        reasons[valid[position]] = "not supported by the matching engine"
    return reasons


def load_rules(
    spark: SparkSession, files: Sequence[RuleFile], pack: str = "default", max_rules: int = MAX_RULES
) -> tuple[DataFrame, DataFrame]:
    """The ``rules`` table of a pack, and the rejected rules with reasons.

    Several files for one list follow each other in the order given. The accepted
    table feeds ``RulePack.from_df``.
    """
    accepted, rejected = [], []
    placed: dict[tuple, int] = {}
    for file in files:
        rules = read_rule_lines(spark, file.path, max_rules)
        place = (file.category, file.lang, file.kind)
        start = placed.get(place, 0)
        placed[place] = start + len(rules)
        tested = rules if file.kind == "rule" else [word_list_rule([r]) for r in rules]
        reasons = check_rules(spark, tested)
        for i, rule in enumerate(rules):
            row = (pack, file.category, file.lang, file.kind, start + i, rule)
            if i in reasons:
                logger.warning("rule skipped (%s): %s", reasons[i], rule)
                rejected.append((*row, reasons[i]))
            else:
                accepted.append(row)
    return spark.createDataFrame(accepted, RULES_SCHEMA), spark.createDataFrame(rejected, REJECTED_SCHEMA)


def usable_rules(spark: SparkSession, path: str, as_words: bool = False) -> list[str]:
    """The rules of one file without the rejected ones, which are logged."""
    rules = read_rule_lines(spark, path)
    reasons = check_rules(spark, [word_list_rule([r]) for r in rules] if as_words else rules)
    for i, reason in reasons.items():
        logger.warning("rule skipped (%s): %s", reason, rules[i])
    return [rule for i, rule in enumerate(rules) if i not in reasons]


def load_three_category_pack(
    spark: SparkSession,
    explicit: Mapping[str, str],
    race: str | None = None,
    religion: str | None = None,
    royalty: str | None = None,
    hard: str | None = None,
) -> RulePack:
    """The default categories around rule files: explicit ones by language, one
    per category, and the words that confirm the race category in any context."""

    def rules(path: str | None, as_words: bool = False) -> list[str]:
        return usable_rules(spark, path, as_words) if path else []

    return three_category_pack(
        {lang: rules(path) for lang, path in explicit.items()},
        race=rules(race),
        religion=rules(religion),
        royalty=rules(royalty),
        hard=rules(hard, as_words=True),
    )
