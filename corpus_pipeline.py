"""A training-data pipeline over ``documents``: five stages, each written before the next reads it.

language: keeps documents in a determined language. near_duplicates: keeps one document of
each group. personal_data: replaces personal data and what reveals it. mixing: takes what
the source weights ask for. encoding: token ids, and a digest of the text decoded from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import bpe, forest, language, mixing, privacy
from sievemark.llm.queries import tokenizer_path
from sievemark.llm.scratch import step
from sievemark.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Near copies: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.
NEAR_WIDTH, NEAR_PERCENT = 5, 80


@step
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter go."""
    held_out = language.fold(F.col("doc_id"), 3) == 1
    training = language.training_texts(docs.where(~held_out))
    return language.identify(docs, training).where(F.col("lang_pred") != language.UNDETERMINED).select(*docs.columns)


@step
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, 0.8): the one with the smallest id."""
    return forest.keep_one(docs, percent=NEAR_PERCENT, width=NEAR_WIDTH)


@step
def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced; ``n_chars`` follows the text."""
    cleaned = privacy.sanitise(privacy.find_spans(docs))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@step
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; ``n_chars`` follows the text where a budget ends in one."""
    taken = mixing.copies(mixing.mix(docs))
    return taken.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@step
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of what they decode to."""
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.round_trip(docs.select("doc_id", "source", "text"), path)


STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: Languages are learnt, tokens come from a vocabulary: no SQL expresses these stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
