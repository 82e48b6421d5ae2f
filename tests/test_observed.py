"""Counters observed while writing equal those read back, and need no second scan."""

from pyspark.sql import functions as F

from sievemark.packs.neutral import NEUTRAL
from sievemark.plans import queries
from sievemark.plans.run import run
from sievemark.session import scratch_path
from sievemark.sources.lines import read_lines

SF = "/root/testdata/sf0.001"


def test_observed_equals_read_back(spark):
    observed = queries.observed_accounting(spark, SF).first().asDict()
    read = queries.summary_file(spark, SF).first().asDict()
    assert observed == read and observed["total_processed"] > 0


def test_summary_with_rejected_lines_reads_nothing_again(spark):
    path = scratch_path(spark, "observed-lines")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    line = F.when(F.col("doc_id") % 5 == 0, F.lit('{"text": null}')).otherwise(F.to_json(F.struct("text")))
    docs.select(line.alias("value")).write.text(path)
    lines = read_lines(spark, path)
    results = []
    for observed in (False, True):
        output = scratch_path(spark, "observed-run")
        summary = run(lines.documents, NEUTRAL, output, stem=None, rejected=lines.rejected, observed=observed)
        row = summary.first().asDict()
        results.append({k: v for k, v in row.items() if k.startswith("total_")})
    assert results[0] == results[1] and results[1]["total_rejected"] == docs.where("doc_id % 5 = 0").count()
