"""A complete screening run: match once, derive every output from that."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievemark.operators.report import flagged_detail, flagged_table, issue_counters, observed_summary, run_summary
from sievemark.operators.review import reapply_scored
from sievemark.operators.screen import ScreenConfig, screen
from sievemark.operators.review import KEYS
from sievemark.packs import RulePack
from sievemark.session import setting
from sievemark.sources import sinks

# Names of the report outputs.
DETAIL_NAME = "flagged.jsonl"
TABLE_NAME = "flagged_summary.csv"
SUMMARY_NAME = "summary.json"
REJECTED_NAME = "rejected.jsonl"


def write_scored(scored: DataFrame, path: str) -> DataFrame:
    """Write scored documents partitioned by ``keep`` and read them back.

    This is the only step that matches rules. Records stay in input order.
    """
    # A task keeps one file per value of ``keep`` open, so nothing is sorted.
    with setting(scored.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        scored.write.mode("overwrite").partitionBy("keep").parquet(path)
    return scored.sparkSession.read.schema(scored.schema).parquet(path)


def run(
    documents: DataFrame,
    pack: RulePack,
    output: str,
    stem: str | None = "dataset",
    config: ScreenConfig = ScreenConfig(),
    text_only: bool = False,
    ordered: bool = False,
    keys: Sequence[str] = KEYS,
    text: str = "text",
    rejected: DataFrame | None = None,
    per_file: bool = False,
    observed: bool = False,
) -> DataFrame:
    """Screen ``documents`` with ``keys`` and ``text`` into ``output``.

    ``keys`` name a document: dataset and line, or any id of its own. ``stem`` names
    the cleaned corpus; with None it follows the dataset, if there is only one.
    ``rejected`` lines (see ``read_lines``) are written beside the reports and counted.

    Writes the scored table, the cleaned corpus (unless switched off) and the
    reports, and returns the one-row summary. Everything after the scored table
    reads only the part and the columns it needs. Files follow the input within
    each task; with ``ordered`` the outputs are sorted by key as a whole, which
    shuffles them. With ``per_file`` every input dataset gets its own cleaned corpus,
    ``{stem}_cleaned.jsonl``, in the order of its lines, and ``reports/cleaned_files.jsonl``
    lists them. With ``observed`` the summary's counters are taken while the scored
    table and the rejected lines are written, by Spark observations, instead of by
    reading them again.
    """
    started = time.monotonic()
    output = output.rstrip("/")
    screened = screen(documents, pack, config, text=text)
    watched = Observation("scored") if observed else None
    if watched is not None:
        counted = [*issue_counters(screened, pack), F.count(F.lit(1)).alias("total_processed")]
        screened = screened.observe(watched, *counted)
    scored = write_scored(screened, f"{output}/scored")
    stem = stem or _stem_of(scored)

    def arranged(df: DataFrame) -> DataFrame:
        return df.orderBy(*keys) if ordered else df

    cleaned = sinks.cleaned_path(output, stem) if config.write_cleaned and not per_file else None
    if config.write_cleaned and per_file:
        datasets = [r[0] for r in scored.select("dataset_id").distinct().collect()]  # one per input file
        manifest = sinks.write_cleaned_per_file(
            scored.where(F.col("keep")), datasets, output, f"{output}/staging", keys[1:], text_only, text
        )
        sinks.write_jsonl(manifest.coalesce(1), f"{output}/reports/{sinks.MANIFEST_NAME}")
    if cleaned:
        sinks.write_cleaned(arranged(scored.where(F.col("keep"))), cleaned, text_only, text)
    # Reports name the line before the dataset.
    shown = ("line_no", "dataset_id") if tuple(keys) == KEYS else tuple(keys)
    sinks.write_jsonl(arranged(flagged_detail(scored, pack, shown, text)), f"{output}/reports/{DETAIL_NAME}")
    sinks.write_csv(arranged(flagged_table(scored, pack, shown, text)), f"{output}/reports/{TABLE_NAME}")
    total_rejected = None
    if rejected is not None:
        lost = Observation("rejected") if observed else None
        sinks.write_jsonl(rejected.observe(lost, F.count(F.lit(1)).alias("n")) if lost else rejected, f"{output}/reports/{REJECTED_NAME}")
        if lost is not None:
            total_rejected = int(lost.get.get("n", 0) or 0)
        else:
            total_rejected = scored.sparkSession.read.schema(rejected.schema).json(f"{output}/reports/{REJECTED_NAME}").count()
    summary_path = f"{output}/reports/{SUMMARY_NAME}"
    if watched is not None:
        summary = observed_summary(scored.sparkSession, watched.get, pack, time.monotonic() - started, cleaned, total_rejected)
    else:
        summary = run_summary(scored, pack, time.monotonic() - started, cleaned)
    if total_rejected is not None and watched is None:
        summary = summary.withColumn("total_rejected", F.lit(total_rejected).cast("long"))
    sinks.write_summary(summary, summary_path)
    return scored.sparkSession.read.schema(summary.schema).json(summary_path)


def _stem_of(scored: DataFrame, default: str = "dataset") -> str:
    """The name after the only dataset of a run."""
    if "dataset_id" not in scored.columns:
        return default
    two = scored.select("dataset_id").distinct().limit(2).collect()
    if len(two) != 1 or not two[0][0]:
        return default
    return sinks.dataset_stem(two[0][0])


def rerun_with_decisions(
    output: str,
    decisions: DataFrame,
    stem: str | None = "dataset",
    text_only: bool = False,
    schema: StructType | None = None,
    keys: Sequence[str] = KEYS,
    text: str = "text",
) -> str:
    """Rewrite the cleaned corpus of a finished run, honouring keep decisions.

    ``schema`` (of the scored documents) is needed only if a run may be empty.
    """
    reader = decisions.sparkSession.read
    scored = (reader.schema(schema) if schema else reader).parquet(f"{output.rstrip('/')}/scored")
    scored = scored.withColumn("keep", F.col("keep").cast("boolean"))
    path = sinks.custom_cleaned_path(output, stem or _stem_of(scored))
    sinks.write_cleaned(reapply_scored(scored, decisions, keys), path, text_only, text)
    return path
