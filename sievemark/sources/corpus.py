"""Named corpora laid out as ``root/dataset=…/subset=…/split=…``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievemark.sources.numbering import located, numbered, placed

# Characters that partition folders hold in percent form.
_ESCAPED = {chr(c) for c in range(1, 0x20)} | set("\"#%'*/:=?\\\x7f{[]^")


def partition_folder(root: str, **values: str) -> str:
    """The folder of one partition."""
    names = ["".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in v) for v in values.values()]
    return "/".join([root.rstrip("/"), *(f"{key}={name}" for key, name in zip(values, names))])


def read_corpus(
    spark: SparkSession,
    root: str,
    dataset: str,
    subset: str,
    split: str = "train",
    format: str = "parquet",
    number: bool = True,
    schema: StructType | str | None = None,
) -> DataFrame:
    """``documents(dataset_id, line_no, text, …)`` of one dataset, subset and split.

    Only the folder of that partition is listed, and read to infer a schema where none
    is given; names are taken as they stand, never as numbers. Records are numbered
    from 1 through all files, counting those whose text is null or empty, which are
    then left out. Texts are not trimmed.
    """
    reader = spark.read.format(format)
    scan = (reader.schema(schema) if schema else reader).load(
        partition_folder(root, dataset=dataset, subset=subset, split=split)
    )
    records = scan
    if number:
        where = placed if format == "parquet" else located
        records = numbered(where(scan.select("*", "_metadata")).drop("_metadata"), across_files=True)
    name = F.lit("/".join((dataset, subset, split)))
    keys = [name.alias("dataset_id")] + ([F.col("line_no")] if number else [])
    rest = [c for c in records.columns if c not in {"dataset_id", "line_no", "text"}]
    return records.select(*keys, "text", *rest).where(F.length("text") > 0)
