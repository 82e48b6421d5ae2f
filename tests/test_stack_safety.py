"""Rules whose repetition could exhaust the engine's stack: unrolled when equal, else refused."""

import random
import re

from pyspark.sql import functions as F

from sievemark.functions.regex import jvm_pattern, repetition_risk, unrolled
from sievemark.sources.rules import check_rules


def test_the_probe_on_a_long_text(spark):
    rule = r"\bfoo(?:a|b)*bar\b"
    text = "foo" + "ab" * 20_000 + "bar"
    assert len(text) == 40_006 and repetition_risk(rule) is None
    df = spark.createDataFrame([(text,), ("foo" + "ab" * 20_000 + "cbar",)], "t string")
    got = [r[0] for r in df.select(F.col("t").rlike(jvm_pattern(rule))).collect()]
    assert got == [bool(re.search(rule, t, re.I)) for t in (text, "foo" + "ab" * 20_000 + "cbar")] == [True, False]


def test_unrolling_and_risks():
    assert unrolled(r"(?:a|b|[0-9])*x") == r"[ab0-9]*x"
    assert unrolled(r"(a|\d)+") == r"[a\d]+"
    assert unrolled(r"(a|b)*\1") == r"(a|b)*\1"  # groups are counted: left alone
    assert unrolled(r"(?:[^a]|b)*") == r"(?:[^a]|b)*"
    assert repetition_risk(r"(?:ab|cd)*x") and repetition_risk(r"(?:a+b)+")
    assert repetition_risk(r"(?:ab|cd){2,5}") is None and repetition_risk(r"(?:ab)*") is None


def test_refused_with_a_reason_at_load(spark):
    reasons = check_rules(spark, [r"\bfine\b", r"\b(?:ab|cd)*x\b", r"\bfoo(?:a|b)*bar\b"])
    assert list(reasons) == [1] and "stack" in reasons[1]


ATOMS = ["a", "b", "ab", "[ab]", r"\d", "x", "[^a ]", "."]


def _rule(rng):
    parts = []
    for _ in range(rng.randint(1, 4)):
        kind = rng.random()
        if kind < 0.4:
            parts.append(rng.choice(ATOMS))
        elif kind < 0.8:
            alternatives = rng.sample(["a", "b", r"\d", "[xy]", "-", "c"], rng.randint(2, 3))
            opener = rng.choice(["(?:", "("])
            parts.append(opener + "|".join(alternatives) + ")" + rng.choice(["*", "+", "?", "{1,3}", "{2,}"]))
        else:
            parts.append(rng.choice(ATOMS) + rng.choice(["*", "+", "?"]))
    return (r"\b" if rng.random() < 0.3 else "") + "".join(parts)


def test_random_rules_equal_python(spark):
    rng = random.Random(7)
    rules = [r for r in (_rule(rng) for _ in range(60)) if repetition_risk(r) is None]
    texts = ["".join(rng.choice("ab1-xyc ") for _ in range(rng.randint(0, 14))) for _ in range(80)]
    texts += ["A" * 5 + "B1", "ab" * 3000, "1-" * 2000 + "c"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(*[F.col("t").rlike(jvm_pattern(r)).alias(f"r{i}") for i, r in enumerate(rules)]).collect()
    for row, text in zip(got, texts):
        for i, rule in enumerate(rules):
            assert row[i] == bool(re.search(rule, text, re.I)), (rule, text[:40])
    assert len(rules) > 30
