"""License scans: base places against a plain count, signature rules on known texts, edge cases."""

import re

import pytest
from pyspark.sql import functions as F

from sievemark.llm import licenses
from sievemark.llm.queries import op12_license_scan

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}


def plain_base(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def _scan(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in licenses.scan(df).collect()}


def test_base_places_equal_a_plain_count_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in op12_license_scan(spark, SF).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r = got[d.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(d.text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0.0 <= r.score <= 1.0 and (r.score > 0) == bool(r.labels)


TEXTS = [
    "Released UNDER THE MIT-License; see LICENSE.",
    "Licensed under the Apache License, Version 2.0 (the \"License\").",
    "Content is CC-BY-NC 4.0 and cc by nc again: cc by nc.",
    "This library is distributed under the GNU Lesser General Public License v2.1 or later.",
    None,
    "",
    "Nothing to see; a plain sentence about trees and rivers.",
    "GPL GNU General Public License version 3 only",
]


def test_signatures_priority_and_containment(spark):
    got = _scan(spark, TEXTS)
    assert got[0].base_labels == "mit" and "mit" in got[0].labels.split(",")
    assert got[1].base_labels == "apache-2" and got[1].first_word == 3
    assert got[2].n_base == 3 and "cc-by-nc-4.0" in got[2].labels.split(",")
    lgpl = got[3].labels.split(",")
    # The general licence inside the lesser one is suppressed by containment.
    assert "lgpl-2.1-or-later" in lgpl and "gpl" not in lgpl and got[3].base_labels == ""
    for empty in (4, 5):
        r = got[empty]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.labels, r.score) == (0, 0, None, None, "", 0.0)
    assert got[6].labels == "" and got[6].score == 0.0
    assert "gpl-3-only" in got[7].labels.split(",") and "gpl" in got[7].labels.split(",")  # partial overlap keeps both


def test_detect_words_and_suppression_directly():
    found = licenses.detect("gnu general public license version 2 or later", ["general", "gpl"])
    assert [d["label"] for d in found] == ["gpl-2-or-later"]
    assert found[0]["start"] == 0 and found[0]["end"] == 8
    assert licenses.detect("", ["mit"]) == [] and licenses.detect("mit license", []) == []


def test_long_texts_repeated_rows_clashing_columns_and_empty(spark):
    long = "word " * 300_000 + "under the MIT license"
    rows = [(1, long, "x"), (2, long, "y"), (3, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[1].first_word == 300_000 and got[1].n_words == 300_004
    assert got[1].labels == got[2].labels and "mit" in got[1].labels
    assert got[3].labels == ""
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert licenses.scan(empty).count() == 0


@pytest.mark.parametrize("rule", licenses.RULES[::7])
def test_every_rule_compiles_and_names_a_keyword(rule):
    label, priority, confidence, keyword, pattern = rule
    re.compile(pattern)
    assert 0 < confidence <= 1 and keyword and label
