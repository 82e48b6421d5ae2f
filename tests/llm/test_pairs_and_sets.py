"""Near-duplicates and fingerprints against all pairs, on small tables."""

import hashlib
import random

import brute
import pytest
from pyspark.sql import functions as F

from sievemark.llm import forest, spotsigs
from sievemark.llm.components import components

SCHEMA = "doc_id long, text string, source string"


def _texts(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randint(20, 160))) for _ in range(n)]
    out = []
    for text in base:
        out.append(text)
        for _ in range(rng.randint(0, 3)):
            own = text.split(" ")
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own))
    hub = base[0].split(" ")
    for k in range(40):  # a star: every copy is near the hub, few are near each other
        own = list(hub)
        for i in range(k, len(own), 45):
            own[i] = f"x{k}"
        out.append(" ".join(own))
    out += [None, "", "   ", "One", "one", "one two", "ONE two", "one two three", "a", base[1].upper(), base[1], base[1]]
    rng.shuffle(out)
    return [(i, t, "s") for i, t in enumerate(out)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed):
    rows = _texts(seed)
    got = forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    expected = brute.components([(i, t) for i, t, _ in rows])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected


def test_crowd_around_the_threshold_equals_all_pairs(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(260):
        own = list(base)
        for at in rng.sample(range(300), rng.randint(4, 7)):
            own[at] = f"x{i}_{at}" if rng.random() < 0.5 else f"y{at}"
        rows.append((i, " ".join(own), "s"))
    monkeypatch.setattr(forest, "BLOCK", 32)
    got = forest.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components([(i, t) for i, t, _ in rows])


def test_one_of_each_component_stays(spark):
    rows = _texts(3)
    kept = {r.doc_id for r in forest.keep_one(spark.createDataFrame(rows, SCHEMA)).collect()}
    expected = brute.components([(i, t) for i, t, _ in rows])
    assert kept == {i for i, (_, c) in expected.items() if c == i}


def test_forest_without_rows_and_with_nulls(spark):
    assert forest.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d", "s"), (2, "a b c d", "s"), (2, "a b c d", "s"), (3, None, None), (4, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id) for r in forest.near_duplicates(df).collect()))
    assert [(a, n) for a, n, _ in got] == [(-1, 2), (2, 2), (2, 2), (3, 0), (4, 0)]
    assert {c for a, _, c in got if a >= 2} == {2, 3, 4}
    assert sorted(r.doc_id or -1 for r in forest.keep_one(df).collect()) == [-1, 2, 3, 4]


def test_chains_and_stars_of_edges(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 520)] + [(519, 490)]
    rows = chain + star + [(7, 7), (None, 3), (160, 99)]
    random.Random(1).shuffle(rows)
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert {got[i] for i in range(99, 161)} == {99}
    assert {got[i] for i in [490, *range(500, 520)]} == {490}
    assert got[7] == 7 and 3 not in got


def _documents(spark):
    rng = random.Random(9)
    words = ["the", "of", "and", "in", "der", "die"] + [f"w{i}é" for i in range(60)]
    rows = [(10 * i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 90))), "s") for i in range(1, 90)]
    rows += [(5, None, None), (7, "😀, The Cat! sat on the mat", "s"), (8, "!!!", "s"), (9, "the of", "s")]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_edited_texts_and_likeness(spark):
    rows, df = _documents(spark)
    got = {r.doc_id: r for r in spotsigs.compare_with_edits(df.repartition(4)).collect()}
    order = sorted((i, t or "") for i, t, _ in rows)
    assert set(got) == {i for i, _ in order}
    for k, (i, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(new.encode()).hexdigest()
        own, after = set(spotsigs.read(got[i].fingerprint)), set(spotsigs.read(got[i].edited_fingerprint))
        nxt = set(spotsigs.read(got[order[(k + 1) % len(order)][0]].fingerprint))
        assert got[i].near_edited == pytest.approx(len(own & after) / len(own | after))
        assert got[i].near_next == pytest.approx(len(own & nxt) / len(own | nxt))
    plain = {r.doc_id: r.fingerprint for r in spotsigs.fingerprints(df).collect()}
    assert plain == {i: r.fingerprint for i, r in got.items()}


def test_signatures_are_anchor_and_chain(spark):
    same = ["the cat sat", "THE, cat (sat)!", "x the cat sat"]
    sets = [set(s) for s in spotsigs.signature_sets(_column(same))]
    assert sets[0] == sets[1]
    assert len(sets[0]) == 2 and len(sets[0] & sets[2]) == 1  # the chain behind "the" is shared
    assert [len(s) for s in spotsigs.signature_sets(_column(["", None, "the of", "!!"]))] == [1, 1, 1, 1]


def test_texts_without_anchors_are_covered_to_their_end():
    words = [f"słowo{i}" for i in range(40)]
    texts = [" ".join(words), " ".join(words[:20] + ["inne"] * 20), " ".join(words[:39] + ["inne"]), " ".join(words) + " the"]
    a, b, c, d = spotsigs.signature_sets(_column(texts))
    assert len(a) == 41 and spotsigs.likeness(a, b) < 0.6 and 0.9 < spotsigs.likeness(a, c) < 1
    assert spotsigs.likeness(a, d) == 1.0  # an anchor with nothing behind it spots nothing


def _column(values):
    import pyarrow as pa

    return pa.array(values, pa.string())


def test_search_finds_every_near_fingerprint(spark):
    rng = random.Random(3)
    words = ["the", "of", "and", "in"] + [f"w{i}" for i in range(300)]
    rows = []
    for i in range(40):
        text = [rng.choice(words) for _ in range(rng.randint(30, 120))]
        rows.append((4 * i, " ".join(text)))
        for k in range(1, 4):
            own = list(text)
            for _ in range(k):
                own[rng.randrange(len(own))] = rng.choice(words)
            rows.append((4 * i + k, " ".join(own)))
    prints = spotsigs.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).cache()
    queries = prints.where(F.col("doc_id") % 20 == 0)
    got = {(r.query_id, r.id): r.likeness for r in spotsigs.search(prints, queries, 0.8).collect()}
    sets = {r.doc_id: set(spotsigs.read(r.fingerprint)) for r in prints.collect()}
    expected = {
        (q, i): len(sets[q] & s) / len(sets[q] | s)
        for q in sets if q % 20 == 0 for i, s in sets.items()
        if i != q and len(sets[q] & s) >= 0.8 * len(sets[q] | s)
    }
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_no_fingerprints_without_rows(spark):
    assert spotsigs.compare_with_edits(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spotsigs.compare_with_edits(spark.createDataFrame([(1, "the cat", "s")], SCHEMA)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
