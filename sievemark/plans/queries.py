"""The registered queries: each operator over whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievemark.operators import report, review
from sievemark.operators.evaluate import confusion, pass_counts, passes
from sievemark.operators.evidence import entity_hits, with_evidence
from sievemark.operators.indexed import rule_hits
from sievemark.operators.proximity import boosted
from sievemark.operators.scores import EXPLICIT_SCORE, score, with_scores
from sievemark.operators.screen import ScreenConfig, screen, screen_categories, screen_explicit
from sievemark.packs import RulePack
from sievemark.packs.neutral import MIXED, NEUTRAL, WIDE
from sievemark.plans.run import (
    DETAIL_NAME,
    REJECTED_NAME,
    SUMMARY_NAME,
    TABLE_NAME,
    rerun_with_decisions,
    run,
    write_scored,
)
from sievemark.session import scratch_path
from sievemark.sources import sinks
from sievemark.sources.corpus import read_corpus
from sievemark.sources.lines import read_lines, stream_lines
from sievemark.sources.numbering import located
from sievemark.sources.rules import RuleFile, load_rules
from sievemark.sources.tables import spread
from sievemark.streaming.screening import numbered_batches, running_counters, screen_to_table

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

DOC = ("doc_id",)
ML = ScreenConfig(use_ml=True)
CATEGORIES = [c.name for c in NEUTRAL.categories]


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(_table(spark, sf_dir, "documents"))


def _keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under the key names of a file corpus."""
    return _documents(spark, sf_dir).select(
        F.col("source").alias("dataset_id"), F.col("doc_id").alias("line_no"), "text", "lang"
    )


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screen(_documents(spark, sf_dir), NEUTRAL)


def _joined(column: Column | str) -> Column:
    return F.concat_ws("|", column)


def _size(column: Column | str) -> Column:
    return F.size(column).cast("long")


# --- matching ------------------------------------------------------------------


@query
def explicit_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen_explicit(_documents(spark, sf_dir), NEUTRAL)
    return scored.select(
        "doc_id",
        "explicit.is_explicit",
        "explicit.language",
        _size("explicit.matched_keywords").alias("hits"),
        _joined("explicit.matched_keywords").alias("matched"),
    )


@query
def digit_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other document written with digits for letters, screened reading them back.

    Decisions equal those of the plain texts; evidence keeps the wording of the text.
    """
    documents = _documents(spark, sf_dir)
    tokens = F.regexp_extract_all("text", F.lit(r"(?U)[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+"), F.lit(0))
    lettered = F.transform(
        tokens, lambda t: F.when(t.rlike(r"(?U)\p{L}"), F.translate(t, "oieaOIEA", "01340134")).otherwise(t)
    )
    written = F.when(F.col("doc_id") % 2 == 0, F.array_join(lettered, "")).otherwise(F.col("text"))
    scored = screen(documents.withColumn("text", written), NEUTRAL, ScreenConfig(digit_spellings=True))
    found = F.concat("explicit.matched_keywords", *[f"sensitive.{c}_matches" for c in CATEGORIES])
    return scored.select(
        "doc_id",
        "explicit.is_explicit",
        "explicit.language",
        _size("explicit.matched_keywords").alias("hits"),
        _joined("sensitive.categories").alias("categories"),
        "keep",
        F.forall(found, lambda w: F.instr(F.coalesce("text", F.lit("")), w) > 0).alias("wording_kept"),
    )


@query
def explicit_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen_explicit(_documents(spark, sf_dir), NEUTRAL)
    return scored.select("doc_id", F.posexplode("explicit.matched_keywords").alias("pos", "keyword")).select(
        "doc_id", F.col("pos").cast("long").alias("pos"), "keyword"
    )


@query
def explicit_language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen_explicit(_documents(spark, sf_dir), NEUTRAL)
    return scored.groupBy("explicit.language").agg(F.count(F.lit(1)).alias("documents"))


@query
def threshold_two(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen(_documents(spark, sf_dir), NEUTRAL, ScreenConfig(keyword_threshold=2))
    return scored.select(
        "doc_id",
        "explicit.is_explicit",
        *[f"sensitive.{name}_flagged" for name in CATEGORIES],
        *[_joined(f"sensitive.{name}_matches").alias(f"{name}_matches") for name in CATEGORIES],
        "sensitive.verification_reason",
        "keep",
    )


@query
def wide_rule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A production-sized rule list over every document."""
    scored = screen_explicit(_documents(spark, sf_dir), WIDE)
    return scored.select(
        "doc_id", "explicit.is_explicit", _size("explicit.matched_keywords").alias("rules_hit")
    )


@query
def indexed_rule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The production-sized rule list as a table, joined with the documents' words."""
    rules = spark.createDataFrame(list(enumerate(WIDE.explicit[0][1])), "rule_id long, rule string")
    hits = rule_hits(_documents(spark, sf_dir), rules)
    return hits.select("doc_id", (F.col("rules_hit") > 0).alias("is_explicit"), "rules_hit")


@query
def mixed_rule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A production-sized rule list of which one in 14 is no literal."""
    scored = screen_explicit(_documents(spark, sf_dir), MIXED)
    return scored.select(
        "doc_id", "explicit.is_explicit", _size("explicit.matched_keywords").alias("rules_hit")
    )


@query
def category_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen_categories(_documents(spark, sf_dir), NEUTRAL)
    return scored.select(
        "doc_id",
        "sensitive.is_sensitive",
        _joined("sensitive.categories").alias("categories"),
        *[f"sensitive.{name}_flagged" for name in CATEGORIES],
        *[_joined(f"sensitive.{name}_matches").alias(f"{name}_matches") for name in CATEGORIES],
    )


@query
def category_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule evidence per category before any boost."""
    lists = {f"{c.name}_rules": c.rules for c in NEUTRAL.categories}
    found = with_evidence(_documents(spark, sf_dir), lists, F.col("text"))
    return found.select("doc_id", *[_joined(name).alias(name) for name in lists])


@query
def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return documents.select(
        "doc_id",
        *[_joined(entity_hits(F.col("text"), c.entities)).alias(f"{c.name}_entities") for c in NEUTRAL.categories],
    )


@query
def boost_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An insult word near an entity, whether or not a rule has hit."""
    documents = _documents(spark, sf_dir)
    entities = documents.select(
        "doc_id",
        "text",
        F.lower("text").alias("low"),
        *[entity_hits(F.col("text"), c.entities).alias(c.name) for c in NEUTRAL.categories],
    )
    return entities.select(
        "doc_id",
        *[
            boosted(F.col("text"), F.col("low"), F.col(name), NEUTRAL.amplifiers, 80).alias(f"{name}_boost")
            for name in CATEGORIES
        ],
    )


@query
def conversation_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen(spread(_table(spark, sf_dir, "conversations")), NEUTRAL)
    return scored.select("conv_id", "turn", *_decision_columns())


@query
def page_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen(spread(_table(spark, sf_dir, "pages")), NEUTRAL, text="html")
    return scored.select("page_id", *_decision_columns())


@query
def benchmark_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = screen(_table(spark, sf_dir, "benchmark"), NEUTRAL)
    return scored.select("item_id", *_decision_columns())


def _decision_columns() -> list[Column]:
    return [
        F.col("explicit.language"),
        _joined("explicit.matched_keywords").alias("matched"),
        _joined("sensitive.categories").alias("categories"),
        F.col("sensitive.verification_reason"),
        F.col("keep"),
    ]


# --- verification and decisions --------------------------------------------------


@query
def verify_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _scored(spark, sf_dir)
        .where(F.col("sensitive.alpha_verified").isNotNull())
        .select("doc_id", "sensitive.alpha_verified", "sensitive.verification_reason")
    )


@query
def verify_reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.regexp_extract("sensitive.verification_reason", r"^[a-z_]*", 0)
    return _scored(spark, sf_dir).groupBy(kind.alias("reason")).agg(F.count(F.lit(1)).alias("documents"))


@query
def rescue_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = report.rescue_audit(_scored(spark, sf_dir), NEUTRAL, keys=DOC)
    return audit.select("doc_id", "reason", _joined("matches").alias("matches"), "text_start")


@query
def keep_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _scored(spark, sf_dir)
        .groupBy("lang", "keep")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"))
    )


@query
def skip_switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept documents with one or both checks switched off."""
    documents = _documents(spark, sf_dir)
    runs = {
        "all": ScreenConfig(),
        "no_explicit": ScreenConfig(skip_explicit=True),
        "no_categories": ScreenConfig(skip_categories=True),
        "none": ScreenConfig(skip_explicit=True, skip_categories=True),
    }
    counted = [
        screen(documents, NEUTRAL, config)
        .agg(F.count_if("keep").alias("kept"), F.count_if(~F.col("keep")).alias("flagged"))
        .select(F.lit(name).alias("checks"), "kept", "flagged")
        for name, config in runs.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result


# --- scores ----------------------------------------------------------------------


def _label_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Score tables made from the label table: several labels per document."""
    labels = _table(spark, sf_dir, "labels")
    toxicity = (F.col("doc_id") % 41 + 60 * F.col("toxic")) / F.lit(100.0)
    explicit = labels.select(
        "doc_id",
        F.inline(
            F.array(
                F.struct(F.lit("toxic").alias("label"), toxicity.alias("score")),
                F.struct(F.lit("neutral").alias("label"), (F.col("doc_id") % 97 / F.lit(100.0)).alias("score")),
            )
        ),
    )
    names = [*CATEGORIES, NEUTRAL.safe_label]
    categories = labels.select(
        "doc_id",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("label"),
                        (F.col("doc_id") * (7 * i + 3) % 101 / F.lit(100.0)).alias("score"),
                    )
                    for i, name in enumerate(names)
                ]
            )
        ),
    )
    return explicit, categories


@query
def scored_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    explicit, categories = _label_scores(spark, sf_dir)
    documents = with_scores(_documents(spark, sf_dir), DOC, NEUTRAL, explicit, categories)
    scored = screen(documents, NEUTRAL, ML)
    return scored.select(
        "doc_id",
        "explicit.is_explicit",
        "explicit.ml_label",
        "explicit.ml_score",
        *[f"sensitive.{name}_flagged" for name in CATEGORIES],
        *[F.col("sensitive.ml_scores")[name].alias(f"{name}_score") for name in CATEGORIES],
        "sensitive.alpha_verified",
        "sensitive.verification_reason",
        "keep",
    )


@query
def score_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal, missing and undefined scores, from a table and from a scorer."""
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    number = F.when(F.col("doc_id") % 3 == 0, 0.5).when(F.col("doc_id") % 3 == 1, F.lit(float("nan")))
    options = F.array(
        *[F.struct(F.lit(n).alias("label"), s.cast("double").alias("score")) for n, s in (("neutral", F.lit(0.5)), ("toxic", number), ("b", F.lit(0.1)))]
    )
    table = documents.select("doc_id", F.inline(options))

    def scorer():
        def one(text: str) -> list[tuple[str, float]]:
            number = [0.5, float("nan"), None][int(text) % 3]
            return [("toxic", number), ("neutral", 0.5), ("b", 0.1)]

        return lambda texts: [one(t) for t in texts]

    joined = with_scores(documents, DOC, NEUTRAL, explicit=table).withColumnRenamed(EXPLICIT_SCORE, "from_table")
    shown = joined.withColumn("shown", F.col("doc_id").cast("string"))
    both = score(shown, explicit=scorer, text="shown")
    return both.select(
        "doc_id", F.col("from_table.label").alias("table_label"), F.col(f"{EXPLICIT_SCORE}.label").alias("scorer_label"),
        F.col(f"{EXPLICIT_SCORE}.score").alias("score"), "score_error",
    )


def _length_explicit_scorer():
    return lambda texts: [[("neutral", 0.5), ("toxic", len(t) % 100 / 100)] for t in texts]


def _length_category_scorer():
    return lambda texts: [{"alpha": len(t) % 90 / 100, "safe": len(t) % 80 / 100} for t in texts]


#: Texts a model sees at once in ``scorer_batches``.
SCORER_BATCH = 7


@query
def scorer_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scorers of ``model_scores`` called on batches of seven texts of like length."""
    documents = score(
        _documents(spark, sf_dir), _length_explicit_scorer, _length_category_scorer,
        batch_size=SCORER_BATCH, by_length=True, batch_column="__calls",
    )
    scored = screen(documents, NEUTRAL, ML)
    return scored.select(
        "doc_id",
        "explicit.ml_label",
        "explicit.ml_score",
        F.col("sensitive.ml_scores")["alpha"].alias("alpha_score"),
        "keep",
        F.col("__calls").between(1, SCORER_BATCH).alias("within_batch"),
    )


@query
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scorer called on Arrow batches inside the tasks."""
    explicit_scorer, category_scorer = _length_explicit_scorer, _length_category_scorer
    documents = score(_documents(spark, sf_dir), explicit_scorer, category_scorer)
    scored = screen(documents, NEUTRAL, ML)
    return scored.select(
        "doc_id",
        "explicit.is_explicit",
        "explicit.ml_label",
        "explicit.ml_score",
        F.col("sensitive.ml_scores")["alpha"].alias("alpha_score"),
        F.col("sensitive.ml_scores")["safe"].alias("safe_score"),
        "sensitive.alpha_flagged",
        "keep",
    )


# --- reports ---------------------------------------------------------------------


def _plain(flagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Arrays as text, without the run's timestamp and the score map."""
    kinds = dict(flagged.dtypes)
    columns = [
        _joined(c).alias(c) if kinds[c].startswith("array") else F.col(c)
        for c in flagged.columns
        if c != "timestamp" and not kinds[c].startswith("map") and c not in keys
    ]
    return flagged.select(*keys, *columns)


@query
def flagged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(report.flagged_detail(_scored(spark, sf_dir), NEUTRAL, keys=DOC), DOC)


@query
def flagged_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The time of detection as the reports write it, from an instant given per document."""
    instant = F.timestamp_seconds(F.col("doc_id") * 86_413 + F.lit(0.25))
    detail = report.flagged_detail(_scored(spark, sf_dir), NEUTRAL, keys=DOC, run_ts=instant)
    return detail.select("doc_id", "timestamp")


@query
def flagged_csv_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.flagged_table(_scored(spark, sf_dir), NEUTRAL, keys=DOC).drop("timestamp")


@query
def issue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.issue_summary(_scored(spark, sf_dir), NEUTRAL)


@query
def issue_summary_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.issue_summary(_scored(spark, sf_dir), NEUTRAL, by=["source"])


@query
def issue_tag_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.issue_preview(_scored(spark, sf_dir), NEUTRAL, keys=DOC)


@query
def rule_hit_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = report.rule_statistics(_documents(spark, sf_dir), NEUTRAL)
    return stats.withColumn("ord", F.col("ord").cast("long"))


# --- review ----------------------------------------------------------------------


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.flagged_detail(_scored(spark, sf_dir), NEUTRAL, keys=DOC)


def _decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewers keep what is labelled as good."""
    labels = _table(spark, sf_dir, "labels")
    return labels.select(
        "doc_id", F.when(F.col("quality") == 1, F.lit("keep")).otherwise(F.lit("remove")).alias("decision")
    )


@query
def review_filter_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(review.review_filter(_flagged(spark, sf_dir), "beta"), DOC)


@query
def review_filter_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_filter(_flagged(spark, sf_dir), "porn").select("doc_id", "porn_language")


@query
def review_filter_sensitive(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = review.review_filter(_flagged(spark, sf_dir), "3r")
    return flagged.select("doc_id", _joined("three_r_categories").alias("categories"))


@query
def review_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_search(_flagged(spark, sf_dir), "  Worthless ").select("doc_id", "text_preview")


@query
def review_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = review.review_page(_flagged(spark, sf_dir), page=3, per_page=7, keys=DOC)
    return page.select("doc_id", "is_porn", "is_sensitive_3r", "text_preview")


@query
def review_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.review_totals(_flagged(spark, sf_dir), per_page=7)


@query
def removed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.removed_keys(_flagged(spark, sf_dir), _decisions(spark, sf_dir), DOC)


@query
def reapply_custom_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = review.reapply(_documents(spark, sf_dir), _flagged(spark, sf_dir), _decisions(spark, sf_dir), DOC)
    return clean.select("doc_id", "text")


@query
def reapply_from_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = write_scored(_scored(spark, sf_dir), scratch_path(spark, "scored"))
    clean = review.reapply_scored(scored, _decisions(spark, sf_dir), DOC)
    return clean.select("doc_id", "text", "keep")


@query
def reapply_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.reapply_counts(
        _documents(spark, sf_dir), _flagged(spark, sf_dir), _decisions(spark, sf_dir), DOC
    )


# --- evaluation ------------------------------------------------------------------


@query
def label_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _scored(spark, sf_dir).join(_table(spark, sf_dir, "labels"), "doc_id")
    return confusion(labelled, F.col("toxic") == 1, ~F.col("keep"), by=["lang"])


@query
def label_pass_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic documents are expected to be explicit and to raise category gamma."""
    labelled = _scored(spark, sf_dir).join(_table(spark, sf_dir, "labels"), "doc_id")
    toxic = F.col("toxic") == 1
    expected = F.when(toxic, F.array(F.lit("GAMMA"))).otherwise(F.array().cast("array<string>"))
    passed = passes(toxic, F.col("explicit.is_explicit"), expected, F.col("sensitive.categories"))
    return pass_counts(labelled, passed)


# --- files -----------------------------------------------------------------------


@query
def jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON lines and read back with their id and text."""
    path = scratch_path(spark, "jsonl")
    documents = _documents(spark, sf_dir).select("doc_id", "text", "lang")
    sinks.write_jsonl(documents, path)
    return read_lines(spark, path, {"doc_id": "long", "lang": "string"}, number=False).documents.select(
        "doc_id", "lang", F.col("text")
    )


@query
def any_shard_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed shards and shards named by Spark, read back complete from one folder."""
    path = scratch_path(spark, "shards")
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    even = F.col("doc_id") % 2 == 0
    documents.where(even).write.option("compression", "gzip").json(f"{path}/compressed")
    lines = documents.where(~even).select(F.to_json(F.struct("doc_id", "text")).alias("value"))
    lines.write.text(f"{path}/plain")
    found = read_lines(spark, [f"{path}/compressed", f"{path}/plain"], {"doc_id": "long"}, number=False).documents
    part = F.split("dataset_id", "/")[0]
    return found.select("doc_id", "text", part.alias("part"))


@query
def stable_dataset_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two folders below one root, read alone and together: every line keeps its dataset id."""
    root = scratch_path(spark, "root")
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    folders = {"a": F.col("doc_id") % 2 == 0, "b": F.col("doc_id") % 2 == 1}
    for name, rows in folders.items():
        sinks.write_jsonl(documents.where(rows), f"{root}/{name}")

    def ids(paths: list[str]) -> DataFrame:
        return read_lines(spark, paths, {"doc_id": "long"}, root=root).documents.select("doc_id", "dataset_id")

    alone = ids([f"{root}/a"]).unionByName(ids([f"{root}/b"])).withColumnRenamed("dataset_id", "__alone")
    together = ids([f"{root}/a", f"{root}/b"])
    return together.join(alone, "doc_id").select(
        "doc_id",
        F.split("dataset_id", "/")[0].alias("folder"),
        (F.col("dataset_id") == F.col("__alone")).alias("stable"),
    )


@query
def rule_files_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rule files per language made of the sources of its documents, as one pack."""
    kinds = _table(spark, sf_dir, "documents").select("lang", "source").distinct()
    files = []
    for i, odd in enumerate((True, False)):
        path = scratch_path(spark, "half")
        number = F.regexp_extract("source", "[0-9]+$", 0).cast("long")
        half = kinds.where((number % 2 == 1) == F.lit(odd)).orderBy("lang", "source")
        line = F.concat_ws("-", F.lit(f"part{i}"), "lang", "source")
        half.select(line.alias("value")).coalesce(1).write.text(path)
        files += [RuleFile(path, lang="en"), RuleFile(path, category="kinds")]
    accepted, _ = load_rules(spark, files)
    pack = RulePack.from_df(accepted)
    lists = [("en", pack.explicit[0][1]), ("kinds", pack.category("kinds").rules)]
    rows = [(name, i, rule) for name, rules in lists for i, rule in enumerate(rules)]
    return spark.createDataFrame(rows, "list string, ord long, pattern string")


@query
def run_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run over two folders of files: every line is kept, flagged or rejected."""
    path, output = scratch_path(spark, "twins"), scratch_path(spark, "accounted")
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    text = F.to_json(F.struct("text"))
    line = F.when(F.col("doc_id") % 7 == 0, F.lit('{"text": null}')).otherwise(text)
    for part in ("a", "b"):
        own = documents.where(F.col("doc_id") % 2 == (0 if part == "a" else 1))
        own.select(line.alias("value")).write.text(f"{path}/{part}")
    lines = read_lines(spark, [f"{path}/a", f"{path}/b"])
    run(lines.documents, NEUTRAL, output, stem=None, rejected=lines.rejected)
    summary = spark.read.json(f"{output}/reports/{SUMMARY_NAME}")
    cleaned = spark.read.schema("dataset_id string, line_no long, text string").json(sinks.cleaned_path(output, "dataset"))
    rejected = spark.read.json(f"{output}/reports/{REJECTED_NAME}")
    keys = cleaned.select("dataset_id", "line_no").union(rejected.select("dataset_id", "line_no"))
    counts = keys.agg(F.count_distinct("dataset_id", "line_no"), F.count(F.lit(1))).first()
    return summary.select(
        "total_processed",
        "total_flagged",
        "total_rejected",
        F.col("cleaned_output").endswith("dataset_cleaned.jsonl").alias("named"),
        (F.col("device") == spark.sparkContext.master).alias("known_device"),
        F.lit(counts[0]).cast("long").alias("distinct_keys"),
        F.lit(counts[1]).cast("long").alias("kept_and_rejected"),
    )


@query
def raw_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as a raw text file, numbered on reading.

    A document's lines are neighbours in their file, so its numbers must span
    exactly its lines, blank ones included.
    """
    path = scratch_path(spark, "lines")
    documents = _documents(spark, sf_dir).select("doc_id", "text")
    physical = documents.select("doc_id", F.explode(F.split("text", "\n")).alias("value")).select(
        F.when(F.col("value") == "", "").otherwise(F.concat_ws("\t", "doc_id", "value")).alias("value")
    )
    physical.write.text(path)
    records = read_lines(spark, path).documents
    numbered = records.select(
        F.split("text", "\t")[0].cast("long").alias("doc_id"), "line_no", F.length("text").alias("chars")
    )
    return numbered.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("records"),
        (F.max("line_no") - F.min("line_no") + 1).alias("span"),
        F.sum("chars").alias("chars"),
    )


@query
def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines whose text is missing, null, a number or a string, by turns."""
    path = scratch_path(spark, "mixed")
    labels = _table(spark, sf_dir, "labels")
    key = F.col("doc_id").cast("string")
    line = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit('{"text": null, "doc_id": '), key, F.lit("}")))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit('{"text": '), key, F.lit(', "doc_id": '), key, F.lit("}")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit('{"doc_id": '), key, F.lit("}")))
        .otherwise(F.concat(F.lit('{"text": "'), key, F.lit('", "doc_id": '), key, F.lit("}")))
    )
    labels.select(line.alias("value")).write.text(path)
    lines = read_lines(spark, path, {"doc_id": "long"})
    accepted = lines.documents.select("doc_id", "text", F.lit("").alias("reason"))
    rejected = lines.rejected.select(
        F.get_json_object("line", "$.doc_id").cast("long").alias("doc_id"), F.col("line").alias("text"), "reason"
    )
    return accepted.unionByName(rejected)


@query
def named_corpus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition of a corpus laid out by dataset, subset and split."""
    path = scratch_path(spark, "corpus")
    split = F.when(F.col("doc_id") % 10 == 0, F.lit("validation")).otherwise(F.lit("train"))
    documents = _documents(spark, sf_dir).select(
        F.lit("prose").alias("dataset"), F.col("lang").alias("subset"), split.alias("split"), "doc_id", "text"
    )
    documents.write.partitionBy("dataset", "subset", "split").parquet(path)
    corpus = read_corpus(spark, path, "prose", "en", "train")
    # Numbers run through all files without gaps, whatever the file layout.
    return corpus.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("doc_id").alias("ids"),
        F.min("line_no").alias("first_no"),
        F.max("line_no").alias("last_no"),
        F.sum("line_no").alias("numbers"),
    )


@query
def rule_file_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule file made of the kinds of documents, with comments and bad rules."""
    path = scratch_path(spark, "rules")
    kinds = _table(spark, sf_dir, "documents").select("lang", "source").distinct()
    name = F.concat_ws("-", "lang", "source")
    line = (
        F.when(F.col("source") == "src1", F.concat(F.lit("  # "), name))
        .when(F.col("source") == "src2", F.concat(F.lit("("), name))
        .when(F.col("source") == "src3", F.concat(F.lit("(?P<kind>"), name, F.lit(")")))
        .when(F.col("source") == "src4", F.lit("  "))
        .otherwise(F.concat(F.lit("  \\b"), name, F.lit("\\b ")))
    )
    # Only the distinct kinds are left, so one ordered file is enough.
    kinds.orderBy("lang", "source").select(line.alias("value")).coalesce(1).write.text(path)
    accepted, rejected = load_rules(spark, [RuleFile(path, lang="en")])
    columns = [F.col("lang"), F.col("kind"), F.col("ord").cast("long").alias("ord"), F.col("pattern")]
    reason = F.split("reason", ":")[0]
    return accepted.select(*columns, F.lit("").alias("reason")).unionByName(
        rejected.select(*columns, reason.alias("reason"))
    )


def _finished_run(spark: SparkSession, sf_dir: str, name: str) -> str:
    output = scratch_path(spark, name)
    run(_keyed(spark, sf_dir), NEUTRAL, output, stem="documents", text_only=True)
    return output


@query
def cleaned_corpus_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = _finished_run(spark, sf_dir, "cleaned")
    return spark.read.schema("text string").json(sinks.cleaned_path(output, "documents"))


@query
def flagged_json_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = _finished_run(spark, sf_dir, "detail")
    schema = report.flagged_detail(screen(_keyed(spark, sf_dir), NEUTRAL), NEUTRAL).schema
    flagged = spark.read.schema(schema).json(f"{output}/reports/{DETAIL_NAME}")
    return _plain(flagged, ("line_no", "dataset_id"))


@query
def flagged_csv_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = _finished_run(spark, sf_dir, "table")
    schema = report.flagged_table(screen(_keyed(spark, sf_dir), NEUTRAL), NEUTRAL).schema
    flagged = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("escape", '"')
        .option("multiLine", "true")
        .csv(f"{output}/reports/{TABLE_NAME}")
    )
    texts = [name for name, kind in flagged.dtypes if kind == "string" and name != "timestamp"]
    return flagged.drop("timestamp").na.fill("", subset=texts)


@query
def summary_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = _finished_run(spark, sf_dir, "summary")
    summary = spark.read.json(f"{output}/reports/{SUMMARY_NAME}")
    counters = [c for c in summary.columns if c.startswith("total_")]
    return summary.select(*counters)


@query
def cleaned_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line files of 500 documents each, screened into one cleaned file per input, read back.

    ``in_order``: each line follows the one before it in its output; ``home``: the output
    is the one the manifest names for the document's input file.
    """
    path, output = scratch_path(spark, "per-file-input"), scratch_path(spark, "per-file")
    documents = _documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    block = F.floor(F.col("doc_id") / 500).alias("block")
    documents.select("*", block).repartition("block").sortWithinPartitions("block", "doc_id").write.partitionBy(
        "block"
    ).json(path)
    lines = read_lines(spark, path, {"doc_id": "long", "lang": "string", "source": "string"}).documents
    run(lines, NEUTRAL, output, stem=None, per_file=True)
    manifest = spark.read.schema("dataset_id string, output string, lines long").json(
        f"{output}/reports/{sinks.MANIFEST_NAME}"
    )
    names = [r.output for r in manifest.select("output").collect()]  # one per input file
    back = read_lines(spark, [f"{output}/{name}" for name in names], {"doc_id": "long"}, root=output).documents
    back = back.withColumn("__output", F.split("dataset_id", "/")[0])
    before = F.lag("doc_id").over(Window.partitionBy("__output").orderBy("dataset_id", "line_no"))
    homes = lines.select("doc_id", F.col("dataset_id").alias("__input")).join(
        manifest.select(F.col("dataset_id").alias("__input"), F.col("output").alias("__home")), "__input"
    )
    return back.join(homes, "doc_id").select(
        "doc_id",
        "text",
        F.coalesce(before < F.col("doc_id"), F.lit(True)).alias("in_order"),
        (F.col("__output") == F.col("__home")).alias("home"),
    )


@query
def observed_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run whose summary counters were observed while its scored table was written."""
    output = scratch_path(spark, "observed")
    run(_keyed(spark, sf_dir), NEUTRAL, output, stem="documents", text_only=True, observed=True)
    summary = spark.read.json(f"{output}/reports/{SUMMARY_NAME}")
    return summary.select(*[c for c in summary.columns if c.startswith("total_")])


@query
def custom_cleaned_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = _finished_run(spark, sf_dir, "custom")
    documents = _documents(spark, sf_dir).select("doc_id", F.col("source").alias("dataset_id"))
    decisions = (
        _decisions(spark, sf_dir).join(documents, "doc_id").withColumnRenamed("doc_id", "line_no")
    )
    path = rerun_with_decisions(output, decisions, stem="documents", text_only=True)
    return spark.read.schema("text string").json(path)


# --- streams ---------------------------------------------------------------------


def _arrived(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The documents as JSON-line files, as if delivered by a producer."""
    path = scratch_path(spark, name)
    sinks.write_jsonl(_documents(spark, sf_dir).select("doc_id", "text").repartition(16), path)
    return path


@query
def stream_screening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files screened micro-batch by micro-batch into one partitioned table."""
    source = _arrived(spark, sf_dir, "arriving")
    stream = stream_lines(spark, source, {"doc_id": "long"}, max_files_per_trigger=8).documents
    table, checkpoint = scratch_path(spark, "streamed"), scratch_path(spark, "streamed-progress")
    screen_to_table(stream, NEUTRAL, table, checkpoint).awaitTermination()
    schema = screen(_documents(spark, sf_dir).select("doc_id", "text"), NEUTRAL).schema
    return spark.read.schema(schema).parquet(table).select("doc_id", *_decision_columns())


@query
def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals over the stream, as of its last micro-batch."""
    source = _arrived(spark, sf_dir, "counted")
    stream = stream_lines(spark, source, {"doc_id": "long"}, max_files_per_trigger=8).documents
    totals, progress = scratch_path(spark, "totals"), scratch_path(spark, "totals-progress")

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{totals}/batch={batch_id}")

    (
        running_counters(screen(stream, NEUTRAL), NEUTRAL)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
        .awaitTermination()
    )
    published = spark.read.parquet(totals)
    last = published.agg(F.max("batch").alias("batch"))
    return published.join(last, "batch", "left_semi").drop("batch")


@query
def stream_line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers within each arriving file, given per micro-batch."""
    source = _arrived(spark, sf_dir, "numbered")
    target, progress = scratch_path(spark, "numbers"), scratch_path(spark, "numbers-progress")
    number = numbered_batches()
    scan = spark.readStream.option("maxFilesPerTrigger", 8).text(source)
    lines = located(scan.select("value", F.col("_metadata.file_name").alias("file"), "_metadata")).drop("_metadata")

    def publish(batch: DataFrame, batch_id: int) -> None:
        number(batch).select("file", "line_no").write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    (
        lines.writeStream.option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(publish)
        .start()
        .awaitTermination()
    )
    per_file = spark.read.parquet(target).groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_distinct("line_no").alias("distinct_numbers"),
        F.max("line_no").alias("last_no"),
    )
    return per_file.agg(
        F.sum("lines").alias("lines"),
        F.sum("distinct_numbers").alias("distinct_numbers"),
        F.sum("last_no").alias("last_numbers"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept and flagged documents per language with the issue counters."""
    scored = _scored(spark, sf_dir)
    return scored.groupBy("lang").agg(
        F.count(F.lit(1)).alias("total_processed"),
        F.count_if("keep").alias("kept"),
        *report.issue_counters(scored, NEUTRAL),
    )


query(flagship)
