"""Reports, files, review and re-applied decisions."""

import csv
import io
import json
import pathlib

import pytest
from pyspark.sql import functions as F

from sievemark import ScreenConfig, screen
from sievemark.operators import report, review
from sievemark.operators.evaluate import confusion, pass_counts, passes
from sievemark.packs.neutral import NEUTRAL
from sievemark.plans.run import rerun_with_decisions, run
from sievemark.sources.lines import read_lines

TEXTS = [
    "an idiot, a moron, a clown; idiot pathetic",
    "calm text",
    'worthless "quoted", \\ back\nsecond\r\nline ' + "é" * 400,
    "scum from with",
    " this is  padded ",
    "of the was have you",
]


@pytest.fixture(scope="module")
def scored(spark):
    df = spark.createDataFrame([(i, "part.txt", t) for i, t in enumerate(TEXTS, 1)], "line_no long, dataset_id string, text string")
    return screen(df, NEUTRAL).cache()


def read_json_lines(folder):
    files = sorted(pathlib.Path(folder).glob("part-*"))
    return [json.loads(line) for f in files for line in f.read_text(encoding="utf-8").splitlines()]


def test_detail_fields(scored):
    stamp = F.lit("2024-01-02 03:04:05.000006").cast("timestamp")
    detail = report.flagged_detail(scored, NEUTRAL, run_ts=stamp).orderBy("line_no")
    assert detail.columns == [
        "line_no", "dataset_id", "timestamp", "is_porn", "porn_language", "porn_keywords", "porn_ml_score",
        "is_sensitive_3r", "three_r_categories", "alpha_keywords", "beta_keywords", "gamma_keywords",
        "three_r_ml_scores", "alpha_verified", "verification_reason", "text_preview",
    ]
    rows = {r.line_no: r for r in detail.collect()}
    assert set(rows) == {1, 3, 4, 5}
    assert rows[1].timestamp == "2024-01-02T03:04:05.000006"
    assert rows[1].porn_keywords == ["idiot", "moron", "clown", "idiot", "pathetic"]
    assert rows[3].text_preview == TEXTS[2][:300]
    assert rows[4].verification_reason == "hard_slur" and rows[4].alpha_verified


def test_table_fields(scored):
    rows = {r.line_no: r for r in report.flagged_table(scored, NEUTRAL).collect()}
    assert rows[1].porn_keywords_sample == "idiot|moron|clown|idiot|pathetic"
    assert rows[3].text_preview == TEXTS[2][:200].replace("\n", " ")
    assert rows[3].beta_keywords_sample == "worthless" and rows[3].three_r_categories == "BETA"


def test_reports_of_a_switched_off_check(spark):
    df = spark.createDataFrame([(1, "d", "idiot scum")], "line_no long, dataset_id string, text string")
    no_categories = screen(df, NEUTRAL, ScreenConfig(skip_categories=True))
    row = report.flagged_detail(no_categories, NEUTRAL).first()
    assert row.three_r_categories == [] and row.alpha_keywords == [] and row.three_r_ml_scores == {}
    assert row.alpha_verified is None and row.verification_reason == ""
    no_explicit = screen(df, NEUTRAL, ScreenConfig(skip_explicit=True))
    row = report.flagged_detail(no_explicit, NEUTRAL).first()
    assert (row.is_porn, row.porn_language, row.porn_keywords, row.porn_ml_score) == (False, "", [], None)
    assert report.issue_summary(no_explicit, NEUTRAL).first().total_porn == 0


def test_preview_and_audit(scored):
    rows = {r.line_no: r for r in report.issue_preview(scored, NEUTRAL).collect()}
    assert rows[1].issues == "PORN[BOTH] 3R:GAMMA"
    assert rows[1].porn_keywords == "«idiot», «moron», «clown», «idiot», «pathetic»"
    assert rows[3].preview.startswith('worthless "quoted", \\ back ↵ second\r ↵ line') and rows[3].issues == "3R:BETA"
    audit = report.rescue_audit(scored, NEUTRAL).collect()
    assert [(r.line_no, r.matches) for r in audit] == [(6, ["of the"])]


def test_run_writes_everything(spark, tmp_path):
    source = tmp_path / "shard.txt"
    source.write_text("\n".join(t.replace("\n", " ").replace("\r", "") for t in TEXTS) + "\n", encoding="utf-8")
    documents = read_lines(spark, str(source)).documents
    out = str(tmp_path / "out")
    summary = run(documents, NEUTRAL, out, stem="shard", text_only=True).first()
    assert summary.total_flagged == 4 and summary.total_processed == 6 and summary.total_porn == 1
    assert summary.cleaned_output == f"{out}/shard_cleaned.jsonl"
    assert read_json_lines(f"{out}/shard_cleaned.jsonl") == [{"text": "calm text"}, {"text": TEXTS[5]}]
    detail = read_json_lines(f"{out}/reports/flagged.jsonl")
    assert len(detail) == 4 and "porn_ml_score" in detail[0] and detail[0]["porn_ml_score"] is None
    assert [d["line_no"] for d in detail] == sorted(d["line_no"] for d in detail)
    [table] = pathlib.Path(f"{out}/reports/flagged_summary.csv").glob("part-*")
    rows = list(csv.DictReader(io.StringIO(table.read_text(encoding="utf-8"), newline="")))
    assert [r["text_preview"] for r in rows] == [d["text_preview"][:200] for d in detail]
    assert rows[1]["text_preview"].startswith('worthless "quoted", \\ back')
    assert rows[0]["porn_ml_score"] == "" and rows[1]["porn_keywords_sample"] == ""

    keep = spark.createDataFrame([("shard.txt", 3, "keep"), ("shard.txt", 1, "remove"), ("no", 4, "keep")], "dataset_id string, line_no long, decision string")
    path = rerun_with_decisions(out, keep, stem="shard", text_only=True)
    assert len(read_json_lines(path)) == 3


def test_cleaned_output_can_be_switched_off(spark, scored, tmp_path):
    documents = scored.select("line_no", "dataset_id", "text")
    out = str(tmp_path / "out")
    summary = run(documents, NEUTRAL, out, config=ScreenConfig(write_cleaned=False)).first()
    assert summary.cleaned_output is None and not pathlib.Path(f"{out}/dataset_cleaned.jsonl").exists()


def test_all_columns_can_be_kept(spark, scored, tmp_path):
    documents = scored.select("line_no", "dataset_id", "text")
    run(documents.repartition(4), NEUTRAL, str(tmp_path), ordered=True)
    assert read_json_lines(tmp_path / "dataset_cleaned.jsonl") == [
        {"line_no": i, "dataset_id": "part.txt", "text": TEXTS[i - 1]} for i in (2, 6)
    ]
    detail = read_json_lines(tmp_path / "reports" / "flagged.jsonl")
    assert [d["line_no"] for d in detail] == [1, 3, 4, 5]


def test_empty_input(spark, tmp_path):
    documents = spark.createDataFrame([], "dataset_id string, line_no long, text string")
    summary = run(documents, NEUTRAL, str(tmp_path)).first()
    assert summary.total_processed == 0 and summary.total_flagged == 0


# --- review ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def flagged(scored):
    return report.flagged_detail(scored, NEUTRAL).cache()


def lines(df):
    return [r.line_no for r in df.orderBy("line_no").collect()]


def test_filters_and_search(flagged):
    assert lines(review.review_filter(flagged, "all")) == [1, 3, 4, 5]
    assert lines(review.review_filter(flagged, "no such filter")) == [1, 3, 4, 5]
    assert lines(review.review_filter(flagged, "porn")) == [1]
    assert lines(review.review_filter(flagged, "3r")) == [1, 3, 4, 5]
    assert lines(review.review_filter(flagged, "beta")) == [3, 5]
    assert lines(review.review_filter(flagged, "alpha")) == [4]
    assert lines(review.review_search(flagged, ' "QUOTED", \\ ')) == [3]
    assert lines(review.review_search(flagged, "%")) == []
    assert lines(review.review_search(flagged, "  ")) == [1, 3, 4, 5]


def test_pages(flagged):
    assert lines(review.review_page(flagged, 1, 3)) == [1, 3, 4]
    assert lines(review.review_page(flagged, 2, 3)) == [5]
    assert lines(review.review_page(flagged, 3, 3)) == []
    assert lines(review.review_page(flagged, -5, 0)) == [1]
    assert lines(review.review_page(flagged, 1, 100_000)) == [1, 3, 4, 5]
    assert review.review_totals(flagged, 3).first().asDict() == {"total": 4, "total_pages": 2}
    assert review.review_totals(flagged.limit(0), 3).first().asDict() == {"total": 0, "total_pages": 0}


def test_reapply_invariants(spark, scored, flagged):
    documents = scored.select("line_no", "dataset_id", "text")
    keys = flagged.select("dataset_id", "line_no")
    none, unknown = keys.limit(0), spark.createDataFrame([("x", 99)], "dataset_id string, line_no long")
    kept = lines(scored.where("keep"))
    for decisions, expected in ((none, kept), (unknown, kept), (keys, [1, 2, 3, 4, 5, 6])):
        assert lines(review.reapply(documents, flagged, decisions)) == expected
        assert lines(review.reapply_scored(scored, decisions)) == expected
    some = keys.where("line_no = 3").unionByName(keys.where("line_no = 3"))
    assert lines(review.reapply(documents, flagged, some)) == sorted([*kept, 3])
    assert lines(review.reapply_scored(scored, some)) == sorted([*kept, 3])
    assert review.reapply_counts(documents, flagged, some).first().asDict() == {"records_written": 3, "records_removed": 3}
    # a removed key without a document still counts as removed
    counts = review.reapply_counts(documents.where("line_no <> 4"), flagged, some).first()
    assert (counts.records_written, counts.records_removed) == (3, 3)


def test_kept_plus_flagged_is_everything(scored):
    split = scored.groupBy().agg(F.count_if("keep").alias("k"), F.count_if(~F.col("keep")).alias("f")).first()
    assert split.k + split.f == len(TEXTS)


def test_evaluation(scored):
    labelled = scored.select("*", (F.col("line_no") <= 3).alias("bad"))
    table = {(r.expected, r.actual): r.documents for r in confusion(labelled, F.col("bad"), ~F.col("keep")).collect()}
    assert table == {(True, True): 2, (True, False): 1, (False, True): 2, (False, False): 1}
    wanted = F.when(F.col("line_no") == 3, F.array(F.lit("BETA"), F.lit("GAMMA"))).otherwise(F.array(F.lit("BETA")))
    passed = passes(F.lit(False), F.col("explicit.is_explicit"), wanted, F.col("sensitive.categories"))
    assert pass_counts(labelled, passed).first().asDict() == {"passed": 1, "failed": 5}
