"""Rule lists as an index joined with documents' words."""

from pyspark.sql import functions as F

from sievemark.operators.indexed import rule_hits, unkeyed
from sievemark.plans import queries

SF = "/root/testdata/sf0.001"


def test_indexed_scan_equals_the_wide_scan(spark):
    wide = {r.doc_id: (r.is_explicit, r.rules_hit) for r in queries.wide_rule_scan(spark, SF).collect()}
    indexed = {r.doc_id: (r.is_explicit, r.rules_hit) for r in queries.indexed_rule_scan(spark, SF).collect()}
    assert indexed == wide and any(n for _, n in wide.values())


def _rule(r):
    return rf"\bw{r - 1} w{r}\b" if r % 10 == 9 else rf"\bw{r % 100_000}\b"


def test_two_hundred_thousand_rules(spark):
    n = 200_000
    rules = spark.range(n).select(
        F.col("id").alias("rule_id"),
        F.when(F.col("id") % 10 == 9, F.format_string(r"\bw%d w%d\b", F.col("id") - 1, F.col("id")))
        .otherwise(F.format_string(r"\bw%d\b", F.col("id") % 100_000))
        .alias("rule"),
    )
    texts = [" ".join(f"W{k}" for k in range(d * 1997, d * 1997 + 12)) + ", end." for d in range(60)]
    texts += [None, "", "w8 w9 w19", "w18  w19"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.rules_hit for r in rule_hits(docs, rules).collect()}
    expected = {}
    for d, text in enumerate(texts):
        words = (text or "").lower().replace(",", " ").replace(".", " ").split()
        single, pairs = set(words), set(zip(words, words[1:])) if text and "  " not in text else set()
        count = 0
        for r in range(n):
            if r % 10 == 9:
                count += (f"w{r - 1}", f"w{r}") in pairs
            else:
                count += f"w{r % 100_000}" in single
        expected[d] = count
    assert got == expected and max(expected.values()) > 10


def test_unkeyed_rules_and_empty_inputs(spark):
    rules = spark.createDataFrame([(0, r"\bfoo\b"), (1, r"\bfo.?o\b"), (2, r"\bthis with\b")], "rule_id long, rule string")
    assert [r.rule_id for r in unkeyed(rules).collect()] == [1]
    docs = spark.createDataFrame([(1, "This  with foo"), (2, "this with"), (2, "this with"), (3, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in rule_hits(docs, rules).collect())
    assert got == [(1, 1), (2, 1), (2, 1), (3, 0)]
    none = spark.createDataFrame([], "rule_id long, rule string")
    assert sorted(tuple(r) for r in rule_hits(docs, none).collect()) == [(1, 0), (2, 0), (2, 0), (3, 0)]
