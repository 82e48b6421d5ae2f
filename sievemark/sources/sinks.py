"""Writers. Each writes in place of what is there, from all tasks at once."""

from __future__ import annotations

import posixpath

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def corpus_stem(dataset: str, subset: str, split: str) -> str:
    """Output name of a named corpus."""
    return f"{dataset}_{subset}_{split}".replace("/", "_")


def file_stem(path: str) -> str:
    """Output name of a line file."""
    return posixpath.splitext(posixpath.basename(path.rstrip("/")))[0]


def dataset_stem(dataset_id: str) -> str:
    """Output name of a dataset id: a file, or ``dataset/subset/split``."""
    parts = dataset_id.split("/")
    if len(parts) >= 3 and "." not in parts[-1]:
        return corpus_stem("/".join(parts[:-2]), *parts[-2:])
    return file_stem(dataset_id)


def cleaned_path(folder: str, stem: str) -> str:
    return f"{folder.rstrip('/')}/{stem}_cleaned.jsonl"


def custom_cleaned_path(folder: str, stem: str) -> str:
    return f"{folder.rstrip('/')}/{stem}_custom_cleaned.jsonl"


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines with explicit nulls."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_cleaned(kept: DataFrame, path: str, text_only: bool = False, text: str = "text") -> None:
    """The kept documents with all input columns, or as ``{"text": …}`` only."""
    decisions = [c for c in ("explicit", "sensitive", "keep") if c in kept.columns]
    write_jsonl(kept.select(F.col(text).alias("text")) if text_only else kept.drop(*decisions), path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header; quotes are doubled and values are not trimmed."""
    (
        df.write.mode("overwrite")
        .option("header", "true")
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(path)
    )


def write_summary(one_row: DataFrame, path: str) -> None:
    """A one-row result as a single JSON file."""
    write_jsonl(one_row.coalesce(1), path)


# Fixed value: the manifest of per-file outputs, beside the reports.
MANIFEST_NAME = "cleaned_files.jsonl"


def unique_stems(dataset_ids: Iterable[str]) -> dict[str, str]:
    """Output stems of datasets, unique: a stem shared by several datasets gets ``-2``,
    ``-3`` … after the first, by dataset id."""
    stems: dict[str, str] = {}
    used: dict[str, int] = {}
    for dataset in sorted(set(dataset_ids)):
        stem = dataset_stem(dataset)
        used[stem] = used.get(stem, 0) + 1
        stems[dataset] = stem if used[stem] == 1 else f"{stem}-{used[stem]}"
    return stems


def write_cleaned_per_file(
    kept: DataFrame,
    datasets: Sequence[str],
    folder: str,
    staging: str,
    order: Sequence[str] = ("line_no",),
    text_only: bool = False,
    text: str = "text",
    dataset: str = "dataset_id",
) -> DataFrame:
    """One cleaned corpus per input dataset, ``{stem}_cleaned.jsonl``, its lines in input order.

    ``datasets`` are all input datasets (one per file; an input whose lines are all
    removed still gets its empty output). Rows are range-partitioned by dataset and
    ``order`` and written partitioned by a dataset number into ``staging``; each such
    folder then becomes the output's folder by a rename, so parts of one output follow
    each other by name. Returns the manifest: dataset, output name and kept lines.
    """
    spark = kept.sparkSession
    stems = unique_stems(datasets)
    numbered = {d: i for i, d in enumerate(sorted(stems))}
    mapping = spark.createDataFrame(
        [(d, i, stems[d]) for d, i in numbered.items()], f"{dataset} string, __file int, output string"
    )
    placed = kept.join(F.broadcast(mapping.drop("output")), dataset)
    keys = ["__file", *order]
    placed = placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    decisions = [c for c in ("explicit", "sensitive", "keep") if c in placed.columns]
    body = placed.select("__file", F.col(text).alias("text")) if text_only else placed.drop(*decisions, dataset)
    body.write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("__file").json(staging)
    _move_folders(spark, staging, {i: cleaned_path(folder, stems[d]) for d, i in numbered.items()})
    counted = kept.groupBy(dataset).agg(F.count(F.lit(1)).alias("lines"))
    return (
        mapping.join(counted, dataset, "left")
        .select(dataset, F.concat("output", F.lit("_cleaned.jsonl")).alias("output"), F.coalesce("lines", F.lit(0)).cast("long").alias("lines"))
    )


def _move_folders(spark, staging: str, targets: Mapping[int, str]) -> None:
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(staging)
    fs = base.getFileSystem(hadoop)
    for number, target in targets.items():
        source, goal = jvm.org.apache.hadoop.fs.Path(f"{staging}/__file={number}"), jvm.org.apache.hadoop.fs.Path(target)
        fs.delete(goal, True)
        if fs.exists(source):
            fs.rename(source, goal)
        else:
            fs.mkdirs(goal)
    fs.delete(base, True)
