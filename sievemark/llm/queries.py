"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm import bpe, dialogue, forest, katz, language, licenses, merkle, mixing, privacy, quality, repair, spotsigs, urls
from sievemark.llm.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    _QUERIES[function.__name__] = function
    return function


def registered() -> dict[str, Query]:
    import corpus_pipeline

    return _QUERIES | {"pipeline": corpus_pipeline.run}


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_repair_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids written in compressed blocks, and what is read back from them per document."""
    path = scratch_path(spark, "blocks")
    repair.write_blocks(table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return repair.read_digests(spark, path)


@query
def op2_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and how alike they are."""
    return spotsigs.compare_with_edits(table(spark, sf_dir, "documents"))


#: Listed beginnings of URLs and what holds for them.
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@query
def op3_path_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every url: by a listed rule, else by its path template."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


@query
def op4_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the text decoded from them, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query
def op5_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text under a model of all words, pairs and triples of six sevenths of them."""
    documents = table(spark, sf_dir, "documents")
    scored = katz.train_and_score(documents, language.fold(F.col("doc_id"), 7) == 2, length=3, pooled=False)
    return scored.withColumnRenamed("id", "doc_id")


@query
def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over links of at least 85 % common shingles."""
    found = forest.near_duplicates(table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("component_id") == F.col("doc_id"))


@query
def op7_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every whole text: counts, base spans as a digest, all spans."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = privacy.find_spans(documents, keep_text=False)
    counts = [privacy.n_spans(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in privacy.KINDS]
    base = F.sha2(privacy.span_text(F.col("base_spans")), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, privacy.span_text(F.col("spans")).alias("spans"))


@query
def op8_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    documents = table(spark, sf_dir, "documents")
    # Counted once and written: three jobs read the sizes.
    path = scratch_path(spark, "sizes")
    documents.select("doc_id", "source", mixing.n_words(F.col("text")).alias("size")).write.parquet(path)
    slim = spark.read.parquet(path)
    return mixing.mix(slim, size="size").select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every whole text, the fixed checks, and the learnt list's verdict."""
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    failed = (n < 50) | (100 * repeated > 50 * n)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("method_keeps")).alias("kept"), "rule",
    )


@query
def op10_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learnt from two thirds of the labelled documents."""
    documents = table(spark, sf_dir, "documents")
    held_out = language.fold(F.col("doc_id"), 3) == 1
    training = language.training_texts(documents.where(~held_out))
    return language.identify(documents.select("doc_id", "text", held_out.alias("held_out")), training).drop("text")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; one in five checked with its text lower-cased."""
    documents = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    text = F.when(tampered, F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text"))
    checked = [text if name == "text" else F.col(name) for name in fields]
    # Texts are read once and digested; only digests and keys move.
    slim = documents.select(
        "doc_id", "source", merkle.leaf([F.col(c) for c in fields]).alias("digest"), merkle.leaf(checked).alias("checked")
    )
    found = merkle.manifest(slim, F.col("source"), F.col("doc_id"), F.col("digest"), F.col("checked"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrase places and labels of every whole text, the signature rules' labels and a score."""
    found = licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least repair cost, audit and repaired digest of every damaged conversation."""
    return dialogue.repair_all(table(spark, sf_dir, "conversations"))
