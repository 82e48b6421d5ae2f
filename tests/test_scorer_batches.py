"""Models see batches of the size asked for, of like length with ``by_length``; results keep their rows."""

from pyspark.sql import functions as F

from sievemark.operators.scores import EXPLICIT_SCORE, score


def test_batches_of_the_size_asked_for(spark):
    calls = spark.sparkContext.accumulator(0)
    texts = [("x" * (i * 37 % 101),) for i in range(250)]
    df = spark.createDataFrame(texts, "text string").repartition(3)

    def make():
        def scorer(batch):
            assert len(batch) <= 7
            if len(batch) > 1:
                # Like length: a sorted buffer hands neighbours in length.
                assert max(map(len, batch)) - min(map(len, batch)) <= 101
            return [[("toxic", len(t) / 100), ("neutral", 0.5)] for t in batch]

        return scorer

    plain = score(df, make, None).select("text", F.col(EXPLICIT_SCORE)["score"].alias("s"))
    cut = score(df, make, None, batch_size=7, by_length=True, batch_column="calls")
    got = cut.select("text", F.col(EXPLICIT_SCORE)["score"].alias("s"), "calls").collect()
    assert sorted((r.text, r.s) for r in got) == sorted((r.text, r.s) for r in plain.collect())
    assert all(1 <= r.calls <= 7 for r in got) and sum(r.calls == 7 for r in got) >= 200
    for r in got:
        assert r.s == max(len(r.text) / 100, 0.5)
