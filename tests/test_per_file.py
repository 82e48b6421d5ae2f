"""One cleaned output per input file, in input order, with a manifest of names."""

import os

from pyspark.sql import functions as F

from sievemark.sources import sinks


def test_unique_stems():
    stems = sinks.unique_stems(["b/x.jsonl", "a/x.jsonl", "c/y.json.gz", "a/x.jsonl"])
    assert stems == {"a/x.jsonl": "x", "b/x.jsonl": "x-2", "c/y.json.gz": "y.json"}


def test_outputs_per_input_in_order(spark, tmp_path):
    rows = [("a/x.jsonl", i, f"a{i}", True) for i in range(300)] + [("b/x.jsonl", i, f"b{i}", i % 3 == 0) for i in range(50)]
    rows += [("c/empty.jsonl", 1, "gone", False)]
    df = spark.createDataFrame(rows, "dataset_id string, line_no long, text string, keep boolean").repartition(7)
    folder = str(tmp_path / "out")
    manifest = sinks.write_cleaned_per_file(
        df.where("keep"), ["a/x.jsonl", "b/x.jsonl", "c/empty.jsonl"], folder, str(tmp_path / "staging"), text_only=True
    )
    found = {r.dataset_id: (r.output, r.lines) for r in manifest.collect()}
    assert found == {"a/x.jsonl": ("x_cleaned.jsonl", 300), "b/x.jsonl": ("x-2_cleaned.jsonl", 17), "c/empty.jsonl": ("empty_cleaned.jsonl", 0)}
    assert sorted(os.listdir(folder)) == ["empty_cleaned.jsonl", "x-2_cleaned.jsonl", "x_cleaned.jsonl"]
    for name, expected in (("x_cleaned.jsonl", [f"a{i}" for i in range(300)]), ("x-2_cleaned.jsonl", [f"b{i}" for i in range(0, 50, 3)])):
        parts = sorted(p for p in os.listdir(f"{folder}/{name}") if p.startswith("part-"))
        texts = []
        for part in parts:
            texts += [r.text for r in spark.read.schema("text string").json(f"{folder}/{name}/{part}").collect()]
        assert texts == expected
    assert spark.read.schema("text string").json(f"{folder}/empty_cleaned.jsonl").count() == 0
    assert not os.path.exists(tmp_path / "staging")
