"""Screening of arriving documents.

The batch expressions hold no state, so they run unchanged on a stream. There is
no event time: nothing is windowed and nothing waits for late data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievemark.operators.report import issue_counters
from sievemark.operators.screen import ScreenConfig, screen
from sievemark.packs import RulePack
from sievemark.sources.numbering import numbered


def screen_to_table(
    stream: DataFrame,
    pack: RulePack,
    path: str,
    checkpoint: str,
    config: ScreenConfig = ScreenConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append scored documents to a table partitioned by ``keep``.

    One query feeds both the kept and the flagged part, so each document is
    matched once, and the file sink adds each micro-batch exactly once.
    """
    return (
        screen(stream, pack, config)
        .writeStream.format("parquet")
        .partitionBy("keep")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def running_counters(scored: DataFrame, pack: RulePack) -> DataFrame:
    """Processed and flagged documents so far; write in update or complete mode."""
    return scored.groupBy().agg(F.count(F.lit(1)).alias("total_processed"), *issue_counters(scored, pack))


def numbered_batches(column: str = "line_no") -> Callable[[DataFrame], DataFrame]:
    """For ``foreachBatch``: number the lines of the files in a micro-batch.

    The streamed frame must be a located file scan (see ``sources.numbering``).
    """
    return lambda batch: numbered(batch, column)
