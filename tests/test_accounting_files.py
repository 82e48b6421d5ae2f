"""The run over two folders is written by all tasks, not by one."""

import glob

from sievemark.plans import queries


def test_no_task_writes_a_whole_folder(spark, tmp_path, monkeypatch):
    rows = [(i, f"plain words number {i}") for i in range(200)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    folders = []

    def noted(spark, paths, *args, **kwargs):
        folders.extend(paths)
        return read_lines(spark, paths, *args, **kwargs)

    read_lines = queries.read_lines
    monkeypatch.setattr(queries, "read_lines", noted)
    row = queries.run_accounting(spark, str(tmp_path)).first()
    assert all(len(glob.glob(f"{folder}/part-*")) > 1 for folder in folders)
    assert (row.total_processed, row.total_rejected, row.distinct_keys) == (171, 29, 200)
