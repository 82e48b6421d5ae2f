"""Rule lists of any length, as an inverted index joined with the documents' words.

A rule list held as expressions grows the plan with every rule (``max_rules``). Here
the rules stay a DataFrame: each is keyed by its rarest required word (document
frequency counted over the scanned documents), documents' distinct words meet that
index by a join, and only the candidates that a key cannot settle are verified by
their regex on the text. No rule is turned into an expression or kept in the driver.

* A whole-word literal of one word hits exactly when the document has that word: the
  join settles it.
* A literal of several words is keyed by its rarest word and verified by regex on the
  texts of the documents that have that word; only those texts are shuffled.
* A rule without a required whole word (any other regex) cannot be keyed. Those go to
  :func:`unkeyed`; callers scan them as expressions, as before.

Defined cases: a null text has no words and hits nothing; rows are matched by doc id
and a digest of their text, so repeated rows each get the same count; an empty table
or rule list gives zero counts; duplicate rules count once per entry, as in a list.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark.functions.regex import SEPARATOR, folded, jvm_pattern, literal_of
from sievemark.session import durable

#: Indexes up to this many rules are broadcast to the documents' words; larger ones are joined by a shuffle.
BROADCAST_RULES = 500_000
#: As many distinct rule words are broadcast to cut the documents' words down to them.
BROADCAST_WORDS = 1_000_000

_ANALYSED = T.StructType(
    [
        T.StructField("literal", T.StringType()),
        T.StructField("words", T.ArrayType(T.StringType())),
        T.StructField("pattern", T.StringType()),
    ]
)


@F.pandas_udf(_ANALYSED)
def _analyse(rules: pd.Series) -> pd.DataFrame:
    literals = [literal_of(rule) if rule is not None else None for rule in rules]
    words = [None if lit is None else [w for w in re.split(r"[^0-9a-z_]+", lit) if w] for lit in literals]
    patterns = [None if rule is None else jvm_pattern(rule) for rule in rules]
    return pd.DataFrame({"literal": literals, "words": words, "pattern": patterns})


def analysed(rules: DataFrame, rule: str = "rule") -> DataFrame:
    """Rules with ``literal`` (lower-case wording of a whole-word literal, else null),
    its ``words``, and the Java ``pattern`` used to verify it."""
    found = _analyse(F.col(rule))
    return rules.withColumn("__a", found).select(
        "*", F.col("__a.literal").alias("literal"), F.col("__a.words").alias("words"), F.col("__a.pattern").alias("pattern")
    ).drop("__a")


def unkeyed(rules: DataFrame) -> DataFrame:
    """Rules that no required word can key: scanned as expressions by the caller."""
    return analysed(rules).where(F.col("literal").isNull() | (F.size("words") == 0))


def _words(text_column: str):
    lowered = folded(F.coalesce(F.col(text_column), F.lit("")))
    return F.array_distinct(F.filter(F.split(lowered, SEPARATOR), lambda w: w != F.lit("")))


def rule_hits(documents: DataFrame, rules: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Per document row: ``rules_hit``, the number of keyed rule entries found.

    ``rules`` has ``rule_id`` (unique per entry) and ``rule``; rules without a key are
    not counted here (see :func:`unkeyed`).
    """
    keyed_docs = documents.select(id, text).withColumn("__key", F.xxhash64(F.col(id), F.col(text)))
    index = analysed(rules.select("rule_id", "rule")).where(F.col("literal").isNotNull() & (F.size("words") > 0))
    index = durable(index.withColumn("__single", F.size("words") == 1))

    rule_words = index.select(F.explode("words").alias("word")).distinct()
    n_words = rule_words.count()
    wanted = F.broadcast(rule_words) if n_words <= BROADCAST_WORDS else rule_words
    # Each document's distinct words that some rule needs: the only rows that meet the index.
    pairs = keyed_docs.select("__key", F.explode(_words(text)).alias("word")).distinct()
    pairs = durable(pairs.join(wanted, "word", "left_semi"))

    frequency = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    per_word = index.select("rule_id", F.explode("words").alias("word")).join(frequency, "word", "left")
    rarest = per_word.groupBy("rule_id").agg(
        F.min_by("word", F.struct(F.coalesce("df", F.lit(0)), F.col("word"))).alias("word")
    )
    keyed = index.join(rarest, "rule_id").select("rule_id", "word", "__single", "pattern")
    n_rules = keyed.count()
    keyed = durable(keyed)
    table = F.broadcast(keyed) if n_rules <= BROADCAST_RULES else keyed
    candidates = pairs.join(table, "word").select("__key", "rule_id", "__single", "pattern")

    settled = candidates.where("__single").groupBy("__key").agg(F.count(F.lit(1)).alias("__n"))
    asked = candidates.where(~F.col("__single")).groupBy("__key").agg(F.collect_list(F.struct("rule_id", "pattern")).alias("__asked"))
    texts = keyed_docs.select("__key", text).dropDuplicates(["__key"])
    verified = texts.join(asked, "__key").select(
        "__key",
        F.size(F.filter("__asked", lambda r: F.regexp_like(F.col(text), r["pattern"]))).cast("long").alias("__n"),
    )
    counts = settled.unionByName(verified).groupBy("__key").agg(F.sum("__n").alias("__n"))
    return (
        keyed_docs.join(counts, "__key", "left")
        .select(id, F.coalesce("__n", F.lit(0)).cast("long").alias("rules_hit"))
    )
