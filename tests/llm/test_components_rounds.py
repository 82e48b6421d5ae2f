"""Components end as soon as every node hangs on its root."""

import importlib

module = importlib.import_module("sievemark.llm.components")


def test_stars_need_no_contraction(spark, monkeypatch):
    kept, durable = [], module.durable
    monkeypatch.setattr(module, "durable", lambda df: kept.append(1) or durable(df))
    stars = spark.createDataFrame([(2, 1), (1, 3), (1, 3), (11, 10), (7, 7), (None, 4)], "u long, v long")
    assert sorted(map(tuple, module.components(stars).collect())) == [(1, 1), (2, 1), (3, 1), (7, 7), (10, 10), (11, 10)]
    assert len(kept) == 1
    chain = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 31), (32, 31)], "u long, v long")
    assert sorted(map(tuple, module.components(chain).collect())) == [*((i, 0) for i in range(21)), (30, 30), (31, 30), (32, 30)]
