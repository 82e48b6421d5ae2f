"""What the plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from sievemark import screen
from sievemark.operators.report import flagged_detail, issue_summary
from sievemark.operators.review import reapply_scored
from sievemark.packs.neutral import NEUTRAL, WIDE
from sievemark.plans.run import write_scored

MATCHING = re.compile(r"RLIKE|regexp_extract")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_screening_is_narrow_and_stays_in_the_jvm(documents):
    plan = plan_of(screen(documents, NEUTRAL))
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


@pytest.mark.parametrize("condition", ["keep", "not keep", "explicit.is_explicit", "sensitive.alpha_verified = false"])
def test_filters_do_not_match_again(documents, condition):
    plan = plan_of(screen(documents, NEUTRAL).where(condition).select("doc_id"))
    filters = [line for line in plan.splitlines() if re.match(r"[\s*():\d+-]*Filter", line)]
    assert filters and not any(MATCHING.search(line) for line in filters)


def test_only_needed_columns_are_read(documents):
    plan = plan_of(flagged_detail(screen(documents, NEUTRAL), NEUTRAL, keys=["doc_id"]))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan


def test_intermediate_results_are_computed_once(documents):
    plan = plan_of(screen(documents, NEUTRAL))
    finder = plan.count("regexp_extract_all")
    assert finder == 8  # literals, boosted entities (3), two counts, both sides of targets


def test_wide_packs_keep_small_plans(documents):
    scored = screen(documents, WIDE)
    assert plan_of(scored).count("regexp_extract_all") == 1


def test_derived_outputs_prune_the_scored_table(spark, documents, tmp_path):
    scored = write_scored(screen(documents, NEUTRAL), str(tmp_path / "scored"))
    detail = plan_of(flagged_detail(scored, NEUTRAL, keys=["doc_id"]))
    assert "PartitionFilters: [isnotnull(keep" in detail and not MATCHING.search(detail)
    summary = plan_of(issue_summary(scored, NEUTRAL))
    assert "text:string" not in summary and "matched_keywords" not in summary.split("ReadSchema")[1]
    keys = documents.select("doc_id").limit(5)
    clean = plan_of(reapply_scored(scored, keys, ["doc_id"]).select("text"))
    assert "BroadcastHashJoin" in clean and "SortMergeJoin" not in clean


def test_records_keep_their_order(spark, tmp_path):
    df = spark.range(20_000).select("id", F.when(F.col("id") % 5 == 0, "idiot").otherwise("calm").alias("text"))
    scored = write_scored(screen(df.coalesce(1), NEUTRAL), str(tmp_path / "scored"))
    for keep in (True, False):
        ids = [r.id for r in scored.where(F.col("keep") == keep).coalesce(1).select("id").collect()]
        assert ids == sorted(ids) and len(ids) == (16_000 if keep else 4_000)
