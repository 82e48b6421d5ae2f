"""Rules that are no literals: one scan each, and only in texts that can hold them."""

import re

from pyspark.sql import functions as F

from sievemark.functions.regex import literal_of, looser_pattern, scan_pattern
from sievemark.operators import evidence
from sievemark.packs.neutral import MIXED

RULES = (
    r"\bth.?en\b", r"\ber.{0,20}on\b", r"\bst.*ea\b", r"\b[ix]sk\b", r"x*", r"\b(?:ab|cd)+e?\b", r"\bth.?en\b",
    r"\bkin.?", r"\ba\b", r"(a)\1", r"\b[sx]e-?s\b", r"\bth|er", r"é.?t", r"\bi[^a]s\b", r"\bit",
)
TEXTS = (
    None, "", "then", "éthen then", "THEN th en th\nen", "er on er 12345678901234567890 on", "st st ea\nea st", "İsk xsk ısk",
    "Kin King kin", "ſe-ſ xes", "aa abcde", "_then then_ x", "theń th\U00010400en", "漢then th漢en", "it's iss i-s été eut",
)


def _expected(text):
    """What each rule's own pattern finds, from Java itself, by ``rlike`` and ``regexp_extract``."""
    return [F.when(text.rlike(evidence.jvm_pattern(r)), F.regexp_extract(text, evidence.jvm_pattern(r), 0)) for r in RULES]


def test_scans_find_what_the_rules_find(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id long, text string").repartition(2)
    want = {r.id: [(i, m) for i, m in enumerate(r.m) if m is not None] for r in df.select("id", F.array(*_expected(F.col("text"))).alias("m")).collect()}
    for part in (RULES, RULES[:3]):
        assert (len(part) > evidence.FEW) == (part is RULES)
        found = evidence.with_evidence(df, {"own": part}, F.col("text"), positions=True).collect()
        got = {r.id: [(e["ord"], e["match"]) for e in r.own] for r in found}
        places = {i for i, rule in enumerate(part) if literal_of(rule) is None}
        assert {i: [e for e in own if e[0] in places] for i, own in got.items()} == {
            i: [e for e in own if e[0] in places] for i, own in want.items()
        }
        assert all([e[0] for e in own] == sorted(e[0] for e in own) for own in got.values())


def test_each_rule_is_scanned_for_once(spark, documents):
    others = [rule for rule in MIXED.explicit[0][1] if literal_of(rule) is None]
    assert len(others) == 41 and all(looser_pattern(rule) and re.compile(looser_pattern(rule)) for rule in others)
    assert all(scan_pattern(rule).startswith("(?idU)" + rule[2]) for rule in others)
    df = evidence.with_evidence(documents, {"own": others}, F.col("text"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") + plan.count("rlike") == 0
    held = documents.select(evidence.possible_rules(F.col("text"), others).alias("p")).select(F.sum(F.size("p"))).first()[0]
    found = df.select(F.sum(F.size("own"))).first()[0]
    assert found <= held <= 1.05 * found
