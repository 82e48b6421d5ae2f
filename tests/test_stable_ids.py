"""Dataset ids below a root stay when folders are added, in batch and in streams."""

import os

import pytest

from sievemark.sources.lines import read_lines, stream_lines


def _write(folder, name, texts):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(texts) + "\n")


def test_ids_stay_when_a_folder_is_added(spark, tmp_path):
    root = str(tmp_path / "corpus")
    _write(f"{root}/a", "x.jsonl", ["one", "two"])
    _write(f"{root}/a", "y.jsonl", ["three"])
    _write(f"{root}/b", "x.jsonl", ["four"])
    alone = read_lines(spark, f"{root}/a", root=root).documents
    both = read_lines(spark, [f"{root}/a", f"{root}/b"], root=root).documents
    ids = lambda df: sorted((r.dataset_id, r.line_no, r.text) for r in df.collect())
    assert ids(alone) == [("a/x.jsonl", 1, "one"), ("a/x.jsonl", 2, "two"), ("a/y.jsonl", 1, "three")]
    assert ids(both) == ids(alone) + [("b/x.jsonl", 1, "four")]
    # Without a root the same files are named differently by what is read along.
    plain = {r.dataset_id for r in read_lines(spark, [f"{root}/a", f"{root}/b"]).documents.collect()}
    assert plain != {r.dataset_id for r in read_lines(spark, f"{root}/a").documents.collect()}
    _write(str(tmp_path / "other"), "z.jsonl", ["five"])
    with pytest.raises(ValueError):
        read_lines(spark, str(tmp_path / "other"), root=root)


def test_stream_ids_keep_equal_names_apart(spark, tmp_path):
    root = str(tmp_path / "arriving")
    _write(f"{root}/p", "p0.jsonl", ["a"])
    _write(f"{root}/q", "p0.jsonl", ["b"])
    found = stream_lines(spark, f"{root}/*", root=root).documents
    query = found.writeStream.format("memory").queryName("stable_ids").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r.dataset_id, r.text) for r in spark.table("stable_ids").collect())
    assert got == [("p/p0.jsonl", "a"), ("q/p0.jsonl", "b")]
