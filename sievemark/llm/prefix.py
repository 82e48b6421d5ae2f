"""Running totals over all rows of a table in a global order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.llm.scratch import scratch_path

_PART, _LOCAL = "__part", "__local_before"


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    value: str,
    out: str,
    group: str | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in ``order``.

    With ``group`` the sum starts anew for each value of that column, which must
    be what ``order`` sorts by first. Rows are range-partitioned once, so a group
    of any size spans many tasks; each task sums its own rows, and only one total
    per task and group is summed across tasks. The table is written to the shared
    folder, because ranges drawn twice would differ.
    """
    schema = T.StructType(
        [*df.schema.fields, T.StructField(_PART, T.IntegerType()), T.StructField(_LOCAL, T.LongType())]
    )
    path = scratch_path(df.sparkSession, "running")

    def local_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, total = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column(value).to_numpy(zero_copy_only=False).astype(np.int64)
            before = np.cumsum(values) - values
            if group is None:
                local, total = before + total, total + int(values.sum())
            else:
                keys = batch.column(group).dictionary_encode()
                codes = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                names = keys.dictionary.to_pylist()
                starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
                local = before - np.repeat(before[starts], np.diff(np.r_[starts, len(codes)]))
                name = None if codes[0] < 0 else names[codes[0]]
                if name == last:
                    local[: starts[1] if len(starts) > 1 else len(codes)] += total
                last = None if codes[-1] < 0 else names[codes[-1]]
                total = int(local[-1] + values[-1])
            arrays = [*batch.columns, pa.array(np.full(len(values), part, np.int32)), pa.array(local)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(local_sums, schema).write.parquet(path)
    written = df.sparkSession.read.parquet(path)
    keys = [_PART] if group is None else [_PART, group]
    totals = written.groupBy(*keys).agg(F.max(F.col(_LOCAL) + F.col(value)).alias("__total"))
    # One row per task (and group in it), never one per row of the table.
    earlier = Window.orderBy(_PART) if group is None else Window.partitionBy(group).orderBy(_PART)
    totals = totals.withColumn(
        "__base", F.coalesce(F.sum("__total").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    renamed = totals.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__base")
    condition = F.col(_PART) == F.col("__k0")
    if group is not None:
        condition = condition & F.col(group).eqNullSafe(F.col("__k1"))
    return (
        written.join(renamed, condition)
        .withColumn(out, (F.col(_LOCAL) + F.col("__base")).cast("long"))
        .select(*df.columns, out)
    )
