"""Rule matching against Python's ``re`` on ordinary and hostile texts."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from plain import ANY_CASE, evidence, words
from pyspark.sql import functions as F

from sievemark.functions.regex import (
    any_rule,
    begun_by,
    independent_words,
    jvm_pattern,
    literal_of,
)
from sievemark.operators.evidence import entity_hits, with_evidence

RULES = (
    r"\bkisi\b",
    r"\bkisi sak\b",
    r"\bkisi sak!is\b",
    r"\bsak\b",
    r"\bKISI\b",
    r"kisi",
    r"\bki.?si\b",
    r"\bk[ia]si\b",
    r"\bkis+i?\b",
    r"\bsak.{0,5}kisi\b",
    r"\bki.*sak\b",
    r"(a)\1",
    r"\bé\b",
    r"sé\b",
    r"\w+!\w",
    r"[\w!]{6}",
    r"\bk\w*\b",
    r"^kisi",
    r"sak$",
    r"\Bs",
    r"s\sk",
    r"(?:ki|sa)(?:si|k)\b",
    r"\b\bsak",
    r"x|\bis\b",
    r"\bsak-is\b",
    r"\bi\.s\b",
    r"\bdon't\b",
    r"\bkisi?\b",
    r"\bsa?k?\b",
    r"\bs!?a*\b",
    r"\bis\.?\b",
    r"s?",
)
ALPHABET = ["k", "i", "s", "a", "K", "S", "I", " ", " ", "!", "-", "'", ".", "\n", "é", "ſ", "K", "İ", "ı",
            " ", "\xa0", "́", "_", "7", "𝒳", "😀", "kisi", "sak", "is", "Kisi Sak", "don't", "i.s"]


def texts(count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(count)]


@pytest.fixture(scope="module")
def random_texts(spark):
    rows = list(enumerate(texts(1500, 7)))
    return rows, spark.createDataFrame(rows, "id int, text string").repartition(4).cache()


def test_evidence_agrees_with_python(random_texts):
    rows, df = random_texts
    got = {r.id: list(r.found) for r in with_evidence(df, {"found": RULES}, F.col("text")).collect()}
    for i, text in rows:
        assert got[i] == evidence(text, RULES), repr(text)


def test_positions_name_the_rule(random_texts):
    rows, df = random_texts
    found = with_evidence(df, {"a": RULES[:4], "b": RULES}, F.col("text"), positions=True).collect()
    for row in found:
        text = rows[row.id][1]
        for column, rules in (("a", RULES[:4]), ("b", RULES)):
            expected = [(i, m[0]) for i, r in enumerate(rules) if (m := re.search(r, text, ANY_CASE))]
            assert [(h.ord, h.match) for h in row[column]] == expected


def test_union_is_found_iff_a_rule_is(random_texts):
    rows, df = random_texts
    for rules in (RULES[:11], RULES[11:], RULES[:-1]):
        got = {r.id: r.hit for r in df.select("id", any_rule(F.col("text"), rules).alias("hit")).collect()}
        for i, text in rows:
            assert got[i] == bool(evidence(text, rules)), repr(text)


def test_guard_leaves_texts_unread(random_texts):
    _, df = random_texts
    found = with_evidence(df, {"found": RULES}, F.col("text"), guard=F.col("id") % 2 == 0)
    assert found.where((F.col("id") % 2 == 1) & (F.size("found") > 0)).count() == 0


@pytest.mark.parametrize("terms", [("kisi", "sak"), ("sak", "kisi sak", "is"), ("sak", "sak-is", "is"), (r"i\.s", "k.?s")])
def test_entities_are_read_left_to_right(random_texts, terms):
    rows, df = random_texts
    got = {r.id: r.hits for r in df.select("id", entity_hits(F.col("text"), terms).alias("hits")).collect()}
    for i, text in rows:
        assert got[i] == words(terms).findall(text), repr(text)


def test_hand_picked_cases(spark):
    rules = [r"\bsaw tooth\b", r"\btooth fairy\b", r"\bTOOTH\b", r"\btooth\b", r"\bnever\b"]
    texts_and_hits = {
        "A Saw Tooth fairy": ["Saw Tooth", "Tooth fairy", "Tooth", "Tooth"],
        "toothé": [],
        "étooth": [],
        "tooth_": [],
        "«tooth»": ["tooth", "tooth"],
        "tooth fairy": ["tooth", "tooth"],
        "": [],
    }
    df = spark.createDataFrame([(t,) for t in texts_and_hits], "text string")
    for row in with_evidence(df, {"found": rules}, F.col("text")).collect():
        assert row.found == texts_and_hits[row.text], row.text


def test_null_text_and_empty_lists(spark):
    df = spark.createDataFrame([(None,), ("x",)], "text string")
    rows = with_evidence(df, {"none": (), "some": (r"\bx\b", "x+")}, F.col("text")).collect()
    assert [(r.none, r.some) for r in rows] == [([], []), ([], ["x", "x"])]


WORDS = ["kisi", "sak", "is", "i.s", "don't", "sak-is"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), min_size=1, max_size=3).map(" ".join), min_size=1, max_size=8))
def test_independent_words_never_share_text(terms):
    independent = independent_words([re.escape(t) for t in terms])
    if independent is None:
        return
    for text in texts(150, 3):
        everywhere = sum(len(words([re.escape(t)]).findall(text)) for t in independent)
        assert everywhere == len(words([re.escape(t) for t in independent]).findall(text))


def test_literals():
    assert literal_of(r"\bAb c\b") == "ab c"
    assert literal_of(r"\bi\.s\b") == "i.s"
    assert literal_of(r"\bdon't\b") == "don't"
    assert [literal_of(r) for r in (r"\ba.b\b", r"\bab?\b", "ab", r"\bé\b", r"\b[ab]c\b", r"\ba|b\b")] == [None] * 6
    assert begun_by(["a", "a b", "a b c", "ab"]) == {"a b": [1], "a b c": [1, 3]}


def test_independent_words():
    assert independent_words(["with", "from"]) == ["with", "from"]
    assert independent_words(["bumi", "orang asli"]) == ["bumi", "orang asli"]
    assert independent_words(["quran", "al-quran"]) is None
    assert independent_words(["saw tooth", "tooth fairy"]) is None
    assert independent_words(["a", "a b"]) is None
    assert independent_words(["a.?b"]) is None


def test_word_boundary_forms():
    assert jvm_pattern(r"\bab\b") == "(?idU)(?<![\\p{L}\\p{N}_\U00010400])ab(?![\\p{L}\\p{N}_])"
    assert "(?<=" in jvm_pattern(r"\bx?y\b")
    assert jvm_pattern(r"[\b]") == r"(?idU)[\b]"
