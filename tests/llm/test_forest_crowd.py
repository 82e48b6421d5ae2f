"""A crowd of texts that are alike, but not alike enough, costs few comparisons."""

import random

import brute

from sievemark.llm import forest


def test_crowd_below_the_threshold_is_not_compared_pair_by_pair(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(200):
        own = list(base)
        for at in rng.sample(range(150), 2 if i % 20 == 0 else 12):
            own[at] = f"x{i}_{at}"
        rows.append((i, " ".join(own)))
    compared = []

    def counted(pairs, sets, percent):
        compared.append(pairs.count())
        return confirmed(pairs, sets, percent)

    confirmed = forest._confirmed
    monkeypatch.setattr(forest, "_confirmed", counted)
    got = forest.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(rows)
    # The last step, after neighbours: all pairs would be some 18,000.
    assert compared[-1] < 2000
