"""Record numbers without moving the records.

Splits of a text file are numbered on their own; only one small row per split (its
length) is shuffled, summed up and joined back. Where the format knows a row's place
in its file (Parquet), one small row per file is enough. The documents themselves
never take part in a shuffle as long as that table is small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sievemark.session import durable

FILE, BLOCK, PLACE = "__file", "__block", "__place"

# Largest split table (bytes of keys and offsets) that is sent to every executor.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024

_MOVED = (
    "the input was split differently than when its splits were counted; "
    "keep split and parallelism settings unchanged between reading and the action"
)


def located(df: DataFrame) -> DataFrame:
    """Add the file and split each record was read from."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def placed(df: DataFrame) -> DataFrame:
    """Add the file and the place in it, for formats that know it (Parquet)."""
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(PLACE))


def _row_in_partition() -> Column:
    # The low 33 bits of the id count the rows of a partition in read order.
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))


def _file_starts(per_file: DataFrame) -> DataFrame:
    """Rows before each file, in path order.

    One row per file is ordered in one place: fine for some ten million files.
    """
    over_files = W.orderBy(FILE).rowsBetween(W.unboundedPreceding, -1)
    return per_file.select(FILE, F.coalesce(F.sum("__rows").over(over_files), F.lit(0)).alias("__start"))


def _small(table: DataFrame) -> DataFrame:
    size = table.agg(F.sum(F.length(FILE) + 64)).first()[0] or 0
    return F.broadcast(table) if size <= MAX_BROADCAST_BYTES else table


def numbered(df: DataFrame, column: str = "line_no", across_files: bool = False) -> DataFrame:
    """Number the records of a located or placed file scan from 1, in file order.

    ``df`` must be the unfiltered scan, so that skipped records still count. Numbers
    restart in each file, or run through all files in path order with
    ``across_files``. A located scan is read twice: once for the split lengths (no
    text columns), once for the data. Should Spark cut or pack the splits differently
    the second time (other settings, other executors), some record falls outside its
    split's counted range or has none, and the job fails instead of numbering wrongly.
    """
    return _by_place(df, column, across_files) if PLACE in df.columns else _by_split(df, column, across_files)


def _by_place(df: DataFrame, column: str, across_files: bool) -> DataFrame:
    if across_files:
        starts = _small(durable(_file_starts(df.groupBy(FILE).agg(F.count(F.lit(1)).alias("__rows")))))
        df = df.join(starts, FILE, "left")
        start = F.coalesce("__start", F.raise_error(F.lit(_MOVED)).cast("long"))
    else:
        df, start = df.withColumn("__start", F.lit(0)), F.col("__start")
    return df.withColumn(column, F.col(PLACE) + start + 1).drop(FILE, PLACE, "__start")


def _by_split(df: DataFrame, column: str, across_files: bool) -> DataFrame:
    location = [FILE, BLOCK]
    rows = df.withColumn("__row", _row_in_partition())
    splits = (
        df.select(*location)
        .withColumn("__row", _row_in_partition())
        .groupBy(*location)
        .agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__rows"))
    )
    in_file = W.partitionBy(FILE).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    offsets = splits.withColumn("__before", F.coalesce(F.sum("__rows").over(in_file), F.lit(0)))
    if across_files:
        starts = _file_starts(splits.groupBy(FILE).agg(F.sum("__rows").alias("__rows")))
        offsets = offsets.join(starts, FILE).withColumn("__before", F.col("__before") + F.col("__start"))
    offsets = _small(durable(offsets.select(*location, "__before", "__first", "__rows")))
    inside = F.col("__row") - F.col("__first")
    number = F.when((inside >= 0) & (inside < F.col("__rows")), F.col("__before") + inside + 1)
    return (
        rows.join(offsets, location, "left")
        .withColumn(column, F.coalesce(number, F.raise_error(F.lit(_MOVED)).cast("long")))
        .drop("__row", "__before", "__first", "__rows", *location)
    )
