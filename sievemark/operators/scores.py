"""Model scores: joined from a table, or computed by a user's scorer.

Either way a document gets two columns: ``explicit_score`` (the best label) and
``category_scores`` (label → score). Without them screening uses rules only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.packs import RulePack

EXPLICIT_SCORE = "explicit_score"
CATEGORY_SCORES = "category_scores"
EXPLICIT_TYPE = "struct<label:string,score:double>"
CATEGORY_TYPE = "map<string,double>"

# Characters of a document that a model is shown.
EXPLICIT_CHARS = 512
CATEGORY_CHARS = 1024

ExplicitScorer = Callable[[list[str]], list[list[tuple[str, float]]]]
CategoryScorer = Callable[[list[str]], list[dict[str, float]]]


def category_labels(pack: RulePack) -> list[str]:
    return [c.score_label for c in pack.categories if c.score_label] + [pack.safe_label]


def _counts(score: Column) -> Column:
    return score.isNotNull() & ~F.isnan(score)


def _best_label(labels: Column, scores: Column, among: Column | None = None) -> Column:
    """The label of the highest score; of equal scores the last label by code point.

    Scores that are null or NaN count for nothing.
    """
    usable = _counts(scores) if among is None else among & _counts(scores)
    return F.max_by(
        F.struct(F.upper(labels).alias("label"), scores.alias("score")), F.when(usable, F.struct(scores, labels))
    )


def _long(scores: DataFrame, keys: Sequence[str], explicit: bool) -> DataFrame:
    return scores.select(*keys, "label", F.col("score").cast("double").alias("score"), F.lit(explicit).alias("__explicit"))


def with_scores(
    documents: DataFrame,
    keys: Sequence[str],
    pack: RulePack,
    explicit: DataFrame | None = None,
    categories: DataFrame | None = None,
) -> DataFrame:
    """Attach what score tables (keys, ``label``, ``score``) say about each document.

    Both tables are reduced together to one row per document, with one fixed aggregate
    per label, so that a key with very many rows needs no more memory than others; one
    join brings them to the documents. Labels without a usable score are left out.
    """
    given = [_long(t, keys, e) for t, e in ((explicit, True), (categories, False)) if t is not None]
    if not given:
        return documents
    rows = given[0] if len(given) == 1 else given[0].unionByName(given[1])
    label, score, is_explicit = F.col("label"), F.col("score"), F.col("__explicit")
    labels = category_labels(pack) if categories is not None else []
    aggregates = [
        F.max(F.when(~is_explicit & (label == name) & _counts(score), score)).alias(f"__s{i}") for i, name in enumerate(labels)
    ]
    added = []
    if explicit is not None:
        aggregates.append(_best_label(label, score, is_explicit).cast(EXPLICIT_TYPE).alias(EXPLICIT_SCORE))
        added.append(F.col(EXPLICIT_SCORE))
    if categories is not None:
        pairs = F.array(*[F.struct(F.lit(name).alias("key"), F.col(f"__s{i}").alias("value")) for i, name in enumerate(labels)])
        known = F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())).cast(CATEGORY_TYPE)
        present = F.col("__categories") > 0
        aggregates.append(F.count_if(~is_explicit & label.isin(labels)).alias("__categories"))
        added.append(F.when(present, known).alias(CATEGORY_SCORES))
    per_document = rows.groupBy(*keys).agg(*aggregates).select(*keys, *added)
    return documents.join(per_document, list(keys), "left")


def with_explicit_scores(documents: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the best ``(label, score)`` of each document."""
    return with_scores(documents, keys, RulePack(), explicit=scores)


def with_category_scores(
    documents: DataFrame, scores: DataFrame, keys: Sequence[str], pack: RulePack
) -> DataFrame:
    """Attach the score of each label the pack knows."""
    return with_scores(documents, keys, pack, categories=scores)


def _careful(make_scorer: Callable, strict: bool) -> Callable[[], Callable]:
    """A loader of the scorer that gives ``(result, error)`` for each text.

    Everything is nested, so that the tasks get it by value and workers need
    not have this package installed.
    """

    def load() -> Callable[[list[str]], list]:
        try:
            scorer = make_scorer()
        except Exception as error:  # no model: go on with rules only, and say so
            if strict:
                raise
            message = f"scorer not loaded: {error!r}"
            return lambda texts: [(None, message)] * len(texts)

        def score(texts: list[str]) -> list:
            if not texts:
                return []
            try:
                found = list(scorer(texts))
                if len(found) != len(texts):
                    raise ValueError(f"{len(found)} results for {len(texts)} texts")
                return [(r, None) for r in found]
            except Exception as error:  # one bad text must not cost the whole batch
                if strict:
                    raise
                if len(texts) == 1:
                    return [(None, repr(error))]
                middle = len(texts) // 2
                return score(texts[:middle]) + score(texts[middle:])

        return score

    return load


def score(
    documents: DataFrame,
    explicit: Callable[[], ExplicitScorer] | None = None,
    categories: Callable[[], CategoryScorer] | None = None,
    text: str = "text",
    explicit_chars: int | None = EXPLICIT_CHARS,
    category_chars: int | None = CATEGORY_CHARS,
    strict: bool = False,
    errors: str | None = "score_error",
    batch_size: int | None = None,
    by_length: bool = False,
    batch_column: str | None = None,
) -> DataFrame:
    """Score with one or both models, loaded once per task, in one Python stage.

    A text that fails gives no score, and its error in the column ``errors`` (None: no
    such column); with ``strict`` the job fails instead. Models are shown the first
    ``explicit_chars`` and ``category_chars`` characters, None for the whole text.

    ``batch_size`` texts go to a model at once, whatever size the Arrow batches have:
    rows are gathered into a buffer of that many (the last call of a task takes what is
    left), with ``by_length`` sorted by length inside it so that a call holds texts of
    like length, and results come back in input order. ``batch_column`` receives the
    number of texts of the call that scored each row.
    """
    if batch_size is not None and batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    loaders = tuple(None if make is None else _careful(make, strict) for make in (explicit, categories))

    @F.pandas_udf(f"explicit {EXPLICIT_TYPE}, categories {CATEGORY_TYPE}, error string, calls long")
    def scored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        first, second = (None if load is None else load() for load in loaders)

        def usable(number) -> bool:
            return number is not None and number == number

        def best(result):
            pairs = [(s, name) for name, s in result or [] if name and usable(s)]
            return {"label": max(pairs)[1].upper(), "score": float(max(pairs)[0])} if pairs else None

        def known(result):
            return {name: float(s) for name, s in (result or {}).items() if usable(s)}

        def answer(short: list, longer: list) -> pd.DataFrame:
            order = list(range(len(short)))
            if by_length:
                order.sort(key=lambda i: len(longer[i] or short[i] or ""))
            step = batch_size or max(len(order), 1)
            one, many, calls = [None] * len(order), [None] * len(order), [0] * len(order)
            for start in range(0, len(order), step):
                part = order[start : start + step]
                nothing = [(None, None)] * len(part)
                got_one = first([short[i] for i in part]) if first else nothing
                got_many = second([longer[i] for i in part]) if second else nothing
                for i, a, b in zip(part, got_one, got_many):
                    one[i], many[i], calls[i] = a, b, len(part)
            chosen = [best(r) for r, _ in one]
            return pd.DataFrame(
                {
                    "explicit": pd.Series([c or {"label": None, "score": None} for c in chosen], dtype="object"),
                    "categories": pd.Series([known(r) for r, _ in many], dtype="object"),
                    "error": pd.Series([a or b for (_, a), (_, b) in zip(one, many)], dtype="object"),
                    "calls": pd.Series(calls, dtype="int64"),
                }
            )

        if batch_size is None:
            for short, longer in batches:
                yield answer(list(short), list(longer))
            return
        # A buffer of batch_size rows across Arrow batches: no more is held at once.
        held_short: list = []
        held_long: list = []
        for short, longer in batches:
            held_short += list(short)
            held_long += list(longer)
            while len(held_short) >= batch_size:
                yield answer(held_short[:batch_size], held_long[:batch_size])
                held_short, held_long = held_short[batch_size:], held_long[batch_size:]
        if held_short:
            yield answer(held_short, held_long)

    def shown(chars: int | None) -> Column:
        return F.col(text) if chars is None else F.substring(text, 1, chars)

    out = documents.withColumn("__scored", scored(shown(explicit_chars), shown(category_chars)))
    if explicit is not None:
        found = F.col("__scored.explicit")
        out = out.withColumn(EXPLICIT_SCORE, F.when(found["label"].isNotNull(), found))
    if categories is not None:
        out = out.withColumn(CATEGORY_SCORES, F.col("__scored.categories"))
    if errors:
        out = out.withColumn(errors, F.col("__scored.error"))
    if batch_column:
        out = out.withColumn(batch_column, F.col("__scored.calls"))
    return out.drop("__scored")


def score_explicit(
    documents: DataFrame, make_scorer: Callable[[], ExplicitScorer], text: str = "text", strict: bool = False
) -> DataFrame:
    """Score with a model held once per task; a text that fails gives nulls."""
    return score(documents, explicit=make_scorer, text=text, strict=strict, errors=None)


def score_categories(
    documents: DataFrame, make_scorer: Callable[[], CategoryScorer], text: str = "text", strict: bool = False
) -> DataFrame:
    """Zero-shot scores per label; a text that fails gives an empty map."""
    return score(documents, categories=make_scorer, text=text, strict=strict, errors=None)


def flagged_by_score(score: Column, pack: RulePack, threshold: float) -> Column:
    """The best label is a toxic one and its score reaches the threshold."""
    return F.coalesce(F.upper(score["label"]).isin(*pack.toxic_labels) & (score["score"] >= threshold), F.lit(False))
