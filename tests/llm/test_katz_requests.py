"""Requests of the back-off model: by stretches of partitions, and shuffles given back."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sievemark.llm import katz

ROWS = [(i, i % 7 == 2, " ".join(f"w{(i * k) % 23}" for k in range(1, 40)) if i % 11 else None) for i in range(120)]


def _scores(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, held boolean, text string").repartition(3)
    return sorted(map(tuple, katz.train_and_score(df, F.col("held")).collect()))


def test_few_tokens_at_a_time_change_nothing(spark, monkeypatch):
    whole = _scores(spark)
    monkeypatch.setattr(katz, "STRETCH_TOKENS", 64)
    assert _scores(spark) == whole and len(whole) == len(ROWS)


def test_shuffles_of_written_tables_are_given_back(spark):
    status = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()
    before = status.size()
    df = spark.createDataFrame(ROWS, "doc_id long, held boolean, text string")
    katz.train_and_score(df, F.col("held"))
    assert status.size() <= before


def test_partitions_are_asked_in_turns_that_change_nothing(spark, monkeypatch):
    def scores():
        return {r[0]: r for r in _scores(spark)}

    turns, asked = [], katz._asked
    monkeypatch.setattr(katz, "_asked", lambda *a: turns.append(a[-2:]) or asked(*a))
    monkeypatch.setattr(katz, "BLOCK_DOCUMENTS", 20)
    monkeypatch.setattr(katz, "VOCABULARY", 5)
    monkeypatch.setattr(katz, "PASSES", 1)
    whole = scores()
    assert turns == [(0, 16)] and len(whole) == len(ROWS)
    monkeypatch.setattr(katz, "PASSES", 5)
    for i, row in scores().items():
        assert row == pytest.approx(whole[i], rel=1e-9)
    assert turns[1:] == [(0, 4), (4, 8), (8, 12), (12, 16)]


def test_only_sums_are_left_behind(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "sievemark"
    before = set(folder.glob("*"))
    df = spark.createDataFrame(ROWS, "doc_id long, held boolean, text string")
    katz.train_and_score(df, F.col("held"))
    left = {path.name.rsplit("-", 1)[0] for path in set(folder.glob("*")) - before if any(path.glob("*"))}
    assert left == {"sums"}
