"""The language model's broadcast words are a matter of speed only: no word's pairs are pooled for its rank."""

import random

import pytest
from pyspark.sql import functions as F

from sievemark.llm import katz


def test_words_beyond_the_broadcast_keep_their_own_pairs(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 4000}" for _ in range(rng.randint(0, 90))) for _ in range(150)]
    rows = [*enumerate(texts), (500, None), (501, ""), (502, "w1 w1 never seen w2")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    held = F.col("doc_id") % 5 == 2
    monkeypatch.setattr(katz, "BLOCK_DOCUMENTS", 20)
    scores = []
    for size in (65_000, 3, 0):
        monkeypatch.setattr(katz, "VOCABULARY", size)
        scores.append({r.id: tuple(r) for r in katz.train_and_score(df, held).collect()})
        words = katz.count_words(df.select(F.col("doc_id").alias("id"), held.alias("held"), "text"), 16)
        known = len(katz.vocabulary(words).hashes)
        assert known > 20 if size == 65_000 else known <= size
    whole, *others = scores
    assert set(whole) == {i for i, _ in rows}
    for other in others:
        for i, row in whole.items():
            assert other[i] == pytest.approx(row, rel=1e-9), i
