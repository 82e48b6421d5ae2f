"""The back-off model of all words: pairs and triples are counted however rare their words are."""

import math
import random
from collections import Counter, defaultdict

import brute
import pytest
from pyspark.sql import functions as F

from sievemark.llm import katz, queries


def _plain(rows, held):
    """The same model by dictionaries: scores, and the probabilities of all that can follow a context."""
    tokens = {i: [*brute.WORD.findall(brute.lowered(t)), "</s>"] for i, t in rows}
    train = [tokens[i] for i, _ in rows if i not in held]
    counts = Counter(w for t in train for w in t)
    total = sum(counts.values())

    def discount(numbers):
        cut = katz.discounts({r: sum(c == r for c in numbers) for r in range(1, katz.K + 2)})
        return lambda c: cut[min(c, katz.K + 1)]

    rare = {w: c for w, c in counts.items() if c <= katz.K + 1 and w != "</s>"}
    cut = discount(rare.values())
    share = sum(rare.values())
    scale = (share + 1) / (total + 2) / share
    first = {w: scale * cut(c) * c if w in rare else (c + (w == "</s>")) / (total + 2) for w, c in counts.items()}
    first["<unseen>"] = scale * sum((1 - cut(c)) * c for c in rare.values())

    def order(grams, lower):
        cut, behind = discount(grams.values()), defaultdict(dict)
        for gram, c in grams.items():
            behind[gram[:-1]][gram[-1]] = c

        def follows(context):
            own = behind.get(context)
            if not own:
                return lower(context[1:])
            below, n = lower(context[1:]), sum(own.values())
            freed = sum((1 - cut(c)) * c for c in own.values())
            starved = freed <= 0
            seen = {w: (1 if starved else cut(c)) * c / (n + starved) for w, c in own.items()}
            alpha = (1 - sum(seen.values())) / (1 - sum(below[w] for w in own))
            return {w: seen.get(w, alpha * p) for w, p in below.items()}

        return follows

    lines = [["<s>", *t] for t in train]
    pairs = order(Counter(p for t in lines for p in zip(t, t[1:])), lambda _: first)
    triples = order(Counter(p for t in lines for p in zip(t, t[1:], t[2:])), pairs)

    def score(t):
        known = ["<s>", *(w if w in first else "<unseen>" for w in t)]
        return math.log10(pairs(("<s>",))[known[1]]) + sum(math.log10(triples(x[:2])[x[2]]) for x in zip(known, known[1:], known[2:]))

    return {i: score(t) for i, t in tokens.items()}, triples


@pytest.mark.parametrize("limits", [{}, {"VOCABULARY": 4, "BLOCK_DOCUMENTS": 20, "PART_TOKENS": 90, "PASSES": 3}])
def test_scores_of_all_words_equal_a_plain_model(spark, monkeypatch, limits):
    rng = random.Random(6)
    words = [f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(3000)]
    words[700:720] = words[40:60]
    rows, at = [], 0
    for i in range(70):
        n = rng.randint(0, 60)
        rows.append((i, " ".join(words[at : at + n]).replace("w3", "W3")))
        at = (at + n) % 1500
    # A context without anything seen seldom behind it, and texts of unseen words, none and one word.
    rows += [(100 + i, "always together") for i in range(8)] + [(200, "never seen"), (201, ""), (202, "w1"), (203, "w1 never w1 w2 w1 w2")]
    held = {i for i, _ in rows if i % 6 == 2 or i in (200, 203)}
    expected, triples = _plain(rows, held)
    for name, value in limits.items():
        monkeypatch.setattr(katz, name, value)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.id: r.score for r in katz.train_and_score(df, F.col("doc_id").isin(held), length=3, pooled=False).collect()}
    assert got == pytest.approx(expected, rel=1e-9)
    for context in (("<s>", "w1"), ("w1", "w2"), ("always", "together"), ("w1", "<unseen>")):
        assert sum(triples(context).values()) == pytest.approx(1.0)


def test_pairs_and_triples_of_rare_words_count_in_the_query(spark, tmp_path):
    free = [i for i in range(400) if brute.fold(i, 7) != 2]
    held = [i for i in range(400) if brute.fold(i, 7) == 2]
    rng, frequent = random.Random(3), [f"f{i}" for i in range(9)]
    rows = [(i, " ".join(rng.choices(frequent, k=30))) for i in free[1:]]
    # Words seen once, as in training and in another order.
    text = " ".join(x for i in range(12) for x in (f"once{i}", f"single{i}"))
    rows += [(free[0], text), (held[0], text), (held[1], " ".join(sorted(text.split())))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r for r in queries.op5_katz_backoff(spark, str(tmp_path)).collect()}
    copy, sorted_copy = got[held[0]], got[held[1]]
    assert copy.held_out and sorted_copy.held_out and copy.base_score == pytest.approx(sorted_copy.base_score)
    assert copy.score > sorted_copy.score + 12
