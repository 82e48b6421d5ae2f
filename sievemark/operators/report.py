"""Reports derived from scored documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.functions.text import empty_strings, iso_utc, preview, quoted_sample, sample
from sievemark.operators.evidence import with_evidence
from sievemark.operators.scores import CATEGORY_TYPE
from sievemark.packs import RulePack

# Field names, lengths, counts and tags of the report formats.
DETAIL_PREVIEW_CHARS = 300
CSV_PREVIEW_CHARS = 200
CSV_EVIDENCE = 5
PREVIEW_EVIDENCE = 6
AUDIT_CHARS = 100
FLAGGED_EXPLICIT = "is_porn"
EXPLICIT_LANGUAGE = "porn_language"
EXPLICIT_EVIDENCE = "porn_keywords"
EXPLICIT_ML_SCORE = "porn_ml_score"
FLAGGED_SENSITIVE = "is_sensitive_3r"
SENSITIVE_CATEGORIES = "three_r_categories"
SENSITIVE_ML_SCORES = "three_r_ml_scores"
TOTAL_FLAGGED = "total_flagged"
TOTAL_EXPLICIT = "total_porn"
TOTAL_CATEGORY = "total_3r_{}"
TAG_EXPLICIT = "PORN[{}]"
TAG_CATEGORY = "3R:"
PREVIEW_NEWLINE = " ↵ "

KEYS = ("line_no", "dataset_id")


def _facts(scored: DataFrame, pack: RulePack) -> dict[str, Column]:
    """Report fields; a check that was switched off leaves neutral values."""
    has_explicit, has_sensitive = "explicit" in scored.columns, "sensitive" in scored.columns
    explicit, sensitive = F.col("explicit"), F.col("sensitive")
    checked = pack.verified
    facts = {
        FLAGGED_EXPLICIT: explicit["is_explicit"] if has_explicit else F.lit(False),
        EXPLICIT_LANGUAGE: explicit["language"] if has_explicit else F.lit(""),
        EXPLICIT_EVIDENCE: explicit["matched_keywords"] if has_explicit else empty_strings(),
        EXPLICIT_ML_SCORE: explicit["ml_score"] if has_explicit else F.lit(None).cast("double"),
        FLAGGED_SENSITIVE: sensitive["is_sensitive"] if has_sensitive else F.lit(False),
        SENSITIVE_CATEGORIES: sensitive["categories"] if has_sensitive else empty_strings(),
    }
    for c in pack.categories:
        facts[f"{c.name}_keywords"] = sensitive[f"{c.name}_matches"] if has_sensitive else empty_strings()
    facts[SENSITIVE_ML_SCORES] = (
        sensitive["ml_scores"]
        if has_sensitive
        else F.map_from_arrays(empty_strings(), F.array().cast("array<double>")).cast(CATEGORY_TYPE)
    )
    if checked:
        name = f"{checked.name}_verified"
        facts[name] = sensitive[name] if has_sensitive else F.lit(None).cast("boolean")
        facts["verification_reason"] = sensitive["verification_reason"] if has_sensitive else F.lit("")
    return facts


def flagged_rows(scored: DataFrame) -> DataFrame:
    return scored.where(~F.col("keep"))


def flagged_detail(
    scored: DataFrame,
    pack: RulePack,
    keys: Sequence[str] = KEYS,
    text: str = "text",
    run_ts: Column | None = None,
    preview_chars: int = DETAIL_PREVIEW_CHARS,
) -> DataFrame:
    """One row per flagged document with all evidence."""
    facts = _facts(scored, pack)
    return flagged_rows(scored).select(
        *keys,
        iso_utc(F.current_timestamp() if run_ts is None else run_ts).alias("timestamp"),
        *[column.alias(name) for name, column in facts.items()],
        preview(F.col(text), preview_chars).alias("text_preview"),
    )


def flagged_table(
    scored: DataFrame,
    pack: RulePack,
    keys: Sequence[str] = KEYS,
    text: str = "text",
    run_ts: Column | None = None,
    preview_chars: int = CSV_PREVIEW_CHARS,
) -> DataFrame:
    """The flat form: evidence samples as text, preview on one line."""
    facts = _facts(scored, pack)
    evidence = {EXPLICIT_EVIDENCE: facts[EXPLICIT_EVIDENCE]} | {
        name: facts[name] for name in (f"{c.name}_keywords" for c in pack.categories)
    }
    samples = {name: sample(column, CSV_EVIDENCE).alias(f"{name}_sample") for name, column in evidence.items()}
    return flagged_rows(scored).select(
        *keys,
        iso_utc(F.current_timestamp() if run_ts is None else run_ts).alias("timestamp"),
        facts[FLAGGED_EXPLICIT].alias(FLAGGED_EXPLICIT),
        facts[EXPLICIT_LANGUAGE].alias(EXPLICIT_LANGUAGE),
        samples.pop(EXPLICIT_EVIDENCE),
        facts[EXPLICIT_ML_SCORE].alias(EXPLICIT_ML_SCORE),
        facts[FLAGGED_SENSITIVE].alias(FLAGGED_SENSITIVE),
        F.concat_ws("|", facts[SENSITIVE_CATEGORIES]).alias(SENSITIVE_CATEGORIES),
        *samples.values(),
        preview(F.col(text), preview_chars, newline=" ").alias("text_preview"),
    )


def issue_counters(scored: DataFrame, pack: RulePack) -> list[Column]:
    """Counters after rescue; one document can add to several."""
    nothing = F.lit(False)
    explicit = F.col("explicit.is_explicit") if "explicit" in scored.columns else nothing
    counters = [
        F.count_if(~F.col("keep")).alias(TOTAL_FLAGGED),
        F.count_if(explicit).alias(TOTAL_EXPLICIT),
    ]
    for c in pack.categories:
        flag = F.col(f"sensitive.{c.name}_flagged") if "sensitive" in scored.columns else nothing
        counters.append(F.count_if(flag).alias(TOTAL_CATEGORY.format(c.name)))
    return counters


def issue_summary(scored: DataFrame, pack: RulePack, by: Sequence[str] = ()) -> DataFrame:
    """The counters over all documents, or per group; partial sums before the shuffle."""
    return scored.groupBy(*by).agg(*issue_counters(scored, pack))


def run_summary(
    scored: DataFrame, pack: RulePack, elapsed_seconds: float, cleaned_output: str | None
) -> DataFrame:
    """One row: the counters and the facts of the run."""
    application = scored.sparkSession.sparkContext.master
    rate = F.col("total_processed") / F.lit(elapsed_seconds) if elapsed_seconds > 0 else F.lit(0.0)
    return scored.agg(
        *issue_counters(scored, pack), F.count(F.lit(1)).alias("total_processed")
    ).select(
        "*",
        F.round(F.lit(elapsed_seconds), 2).alias("elapsed_seconds"),
        F.round(rate, 1).alias("throughput_records_per_sec"),
        F.lit(application).alias("device"),
        F.lit(cleaned_output).cast("string").alias("cleaned_output"),
    )


def observed_summary(
    spark, observed: dict, pack: RulePack, elapsed_seconds: float, cleaned_output: str | None, rejected: int | None = None
) -> DataFrame:
    """The one-row summary of ``run_summary`` from counters observed while writing.

    ``observed`` holds the metrics of an ``Observation`` of ``issue_counters`` and
    ``total_processed`` on the scored write: nothing is read again.
    """
    names = [TOTAL_FLAGGED, TOTAL_EXPLICIT, *[TOTAL_CATEGORY.format(c.name) for c in pack.categories], "total_processed"]
    processed = int(observed.get("total_processed", 0) or 0)
    rate = round(processed / elapsed_seconds, 1) if elapsed_seconds > 0 else 0.0
    fields = [f"{name} long" for name in names]
    fields += ["elapsed_seconds double", "throughput_records_per_sec double", "device string", "cleaned_output string"]
    values = [int(observed.get(name, 0) or 0) for name in names]
    values += [round(elapsed_seconds, 2), rate, spark.sparkContext.master, cleaned_output]
    if rejected is not None:
        fields.append("total_rejected long")
        values.append(int(rejected))
    return spark.createDataFrame([tuple(values)], ", ".join(fields))


def issue_preview(
    scored: DataFrame, pack: RulePack, keys: Sequence[str] = KEYS, text: str = "text"
) -> DataFrame:
    """A reader's view of the flagged documents: tags, one-line text, evidence."""
    facts = _facts(scored, pack)
    before, after = TAG_EXPLICIT.split("{}")
    explicit_tag = F.when(
        facts[FLAGGED_EXPLICIT],
        F.array(F.concat(F.lit(before), F.upper(facts[EXPLICIT_LANGUAGE]), F.lit(after))),
    ).otherwise(empty_strings())
    category_tags = F.transform(facts[SENSITIVE_CATEGORIES], lambda c: F.concat(F.lit(TAG_CATEGORY), c))
    shown = F.when(facts[FLAGGED_EXPLICIT], facts[EXPLICIT_EVIDENCE]).otherwise(empty_strings())
    evidence = {EXPLICIT_EVIDENCE: shown} | {
        name: facts[name] for name in (f"{c.name}_keywords" for c in pack.categories)
    }
    return flagged_rows(scored).select(
        *keys,
        F.concat_ws(" ", explicit_tag, category_tags).alias("issues"),
        preview(F.col(text), CSV_PREVIEW_CHARS, newline=PREVIEW_NEWLINE).alias("preview"),
        *[quoted_sample(column, PREVIEW_EVIDENCE).alias(name) for name, column in evidence.items()],
        F.format_number(facts[EXPLICIT_ML_SCORE], 3).alias("ml_score"),
    )


def rescue_audit(
    scored: DataFrame, pack: RulePack, keys: Sequence[str] = KEYS, text: str = "text"
) -> DataFrame:
    """Documents whose category flag was taken back, with reason and evidence."""
    name = pack.verified.name
    return scored.where(F.col(f"sensitive.{name}_verified") == F.lit(False)).select(
        *keys,
        F.col("sensitive.verification_reason").alias("reason"),
        F.col(f"sensitive.{name}_matches").alias("matches"),
        preview(F.col(text), AUDIT_CHARS).alias("text_start"),
    )


def rule_statistics(documents: DataFrame, pack: RulePack, text: str = "text") -> DataFrame:
    """How many documents each rule hits; rules without hits are not listed."""
    lists = [("explicit", lang, rules) for lang, rules in pack.explicit]
    lists += [("category", c.name, c.rules) for c in pack.categories]
    lists = [entry for entry in lists if entry[2]]

    found = with_evidence(
        documents.select(F.col(text).alias("text")),
        {f"list{i}": rules for i, (_, _, rules) in enumerate(lists)},
        F.col("text"),
        positions=True,
    )

    def tagged(i: int) -> Column:
        return F.transform(f"list{i}", lambda hit: F.struct(F.lit(i).alias("list"), hit["ord"].alias("ord")))

    per_list = [tagged(i) for i in range(len(lists))]
    hits = found.select(F.explode(F.concat(*per_list)).alias("hit")).groupBy("hit").count()
    names = F.array(*[F.lit(kind) for kind, _, _ in lists]), F.array(*[F.lit(name) for _, name, _ in lists])
    patterns = F.array(*[F.array(*[F.lit(rule) for rule in rules]) for _, _, rules in lists])
    return hits.select(
        names[0][F.col("hit.list")].alias("kind"),
        names[1][F.col("hit.list")].alias("list_name"),
        F.col("hit.ord").alias("ord"),
        patterns[F.col("hit.list")][F.col("hit.ord")].alias("pattern"),
        F.col("count").alias("documents"),
    )


