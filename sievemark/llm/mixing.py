"""Mixing sources to target weights: hash-random order, prefix sums, exact budgets.

Every row gets a hash-random key. Rows are range-sorted by source and key, running
word totals within each source come from distributed prefix sums, and each source
is cut where its budget ends. A budget beyond the source's own size repeats it in
whole epochs first.

Defined cases: a null or empty text has size 0 and is never taken; a null source is
a source of its own, last in order; repeated rows are rows like others, and rows
with the same id and size are interchangeable; an empty table gives an empty result;
other columns pass through, names beginning with ``__`` are reserved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemark.llm.columns import without
from sievemark.llm.prefix import running_totals
from sievemark.session import durable

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, source: str, size: str, weights: Sequence[float], max_epochs: int
) -> DataFrame:
    """One row per source: its size and its target in words.

    Weights go round by code point order of the sources, null last. All words of
    the table are shared out by weight; no target exceeds ``max_epochs`` times its
    source, and what is cut off is shared again by weight. That end state is one
    level L with target = min(max_epochs * size, L * weight), found by one sorted
    pass over the sources. One row per source is all that meets in one task.
    """
    per_source = durable(sized.groupBy(source).agg(F.sum(size).cast("long").alias("source_size")))
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    cap = F.lit(float(max_epochs)) * F.col("source_size")
    by_level = Window.orderBy(F.col("__cap") / F.col("__weight"), "__place")
    upto, everywhere = by_level.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0.0)
    levels = (
        per_source.withColumn("__weight", weight)
        .withColumn("__place", place)
        .withColumn("__cap", cap)
        .withColumn("__left", F.sum("source_size").over(everywhere) - F.coalesce(F.sum("__cap").over(upto), zero))
        .withColumn("__open", F.sum("__weight").over(everywhere) - F.coalesce(F.sum("__weight").over(upto), zero))
        .withColumn("__level", F.col("__left") / F.col("__open"))
        # The first source that its share does not fill sets the level for all after it.
        .withColumn("__fits", F.col("__level") * F.col("__weight") <= F.col("__cap"))
    )
    level = F.min_by("__level", F.when(F.col("__fits"), F.struct(F.col("__cap") / F.col("__weight"), "__place")))
    return levels.withColumn("__level", level.over(everywhere)).select(
        F.col(source).alias("__source"),
        "source_size",
        F.least("__cap", F.coalesce(F.col("__level") * F.col("__weight"), F.col("__cap"))).alias("target"),
    )


def mix(
    documents: DataFrame,
    source: str = "source",
    order: str = "doc_id",
    text: str | None = "text",
    size: str | None = None,
    weights: Sequence[float] = (5, 2, 1),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``taken`` (words, repeats counted)."""
    documents = without(documents, "source_size", "target", "taken")
    if size is None:
        documents, size = without(documents, "size").withColumn("size", n_words(F.col(text))), "size"
    targets = durable(source_targets(documents, source, size, weights, max_epochs))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(order).cast("string"), F.lit(""))))
    placed = running_totals(
        documents.withColumn("__key", key),
        [F.col(source).asc_nulls_last(), F.col("__key"), F.col(order), F.col(size)],
        size,
        "__before",
        group=source,
    )
    joined = placed.join(targets, F.col(source).eqNullSafe(F.col("__source")))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col(size), rest - F.col("__before")))
    return joined.withColumn("taken", (epochs * F.col(size) + last).cast("long")).drop("__key", "__before", "__source")


def copies(mixed: DataFrame, text: str = "text", size: str = "size") -> DataFrame:
    """One row for each time a document is taken.

    The document at which a source's budget ends is cut there: that copy holds its
    first words, joined by single spaces.
    """
    whole = F.floor(F.col("taken") / F.col(size)).cast("int")
    rest = (F.col("taken") - whole * F.col(size)).cast("int")
    cut = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), 1, rest), " ")
    texts = F.when(rest > 0, F.concat(F.array_repeat(text, whole), F.array(cut))).otherwise(F.array_repeat(text, whole))
    columns = [F.col("__copy").alias(text) if c == text else F.col(c) for c in mixed.columns]
    return mixed.where(F.col("taken") > 0).withColumn("__copy", F.explode(texts)).select(*columns)
