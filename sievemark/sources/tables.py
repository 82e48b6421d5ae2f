"""Document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

# A table of more splits is never moved just to use more cores.
SMALL_TABLE_SPLITS = 64


def spread(documents: DataFrame) -> DataFrame:
    """Rebalance a small table that has fewer splits than the session has cores.

    Matching is the costly part, so a table of a few files read by a few tasks
    is worth one shuffle. Beyond ``SMALL_TABLE_SPLITS`` moving the texts would
    cost more than idle cores, and the table is left alone.
    """
    cores = documents.sparkSession.sparkContext.defaultParallelism
    splits = documents.rdd.getNumPartitions()
    return documents.repartition(cores) if splits < min(cores, SMALL_TABLE_SPLITS) else documents
