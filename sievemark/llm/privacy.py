"""Personal data: fixed kinds by pattern, and terms that reveal them by co-occurrence.

Base spans are e-mail addresses, IP addresses, card and phone numbers. They are the
protected entities. Corpus statistics then say which ordinary terms give them away:
with p(x) the share of different texts that hold x, and p(e, t) the share in which
term t stands near entity e,

    disclosure(t, e) = log2(p(e, t) / (p(e) p(t))) / -log2 p(e)

is 1 where the term determines the entity and 0 where they are independent. Terms
from ``generalise_at`` on are replaced by a class name where the entity occurs, from
``remove_at`` on they are removed. Copies of a text count once in
all shares, so that copying texts changes no score.

All of it is DataFrame work with built-in functions. Documents without personal data
are read once and pass through; only texts that hold some are kept for the second look.

Defined cases: a null text counts as empty; an empty table gives an empty result;
repeated rows are handled each by itself; positions count code points, ends are
exclusive; extra columns pass through, names beginning with ``__`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.columns import without
from sievemark.llm.scratch import scratch_path

#: Kinds in output order; ``term`` comes from the corpus statistics.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
TAGS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
TERM_TAG = "[TERM]"

# Possessive quantifiers and the guards before them never change what matches; they keep
# long runs of digits or letters from being tried again at every place.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE_PARTS = r"^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])){3}$"
_TERM = r"[\p{L}][\p{L}\p{N}_'-]*+"
_NOT_IN_WORD = r"[\p{L}\p{N}_'-]"
_SPAN = "struct<kind:string,start:int,end:int,value:string>"
_CONTEXT = 100


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Does the check digit fit? From the right, every second digit counts double."""
    places = F.split(F.reverse(digits), "")
    numbers = F.transform(F.filter(places, lambda c: c != ""), lambda c: c.cast("int"))
    sums = F.transform(
        numbers, lambda d, i: F.when(i % 2 == 0, d).when(d < 5, d * 2).otherwise(d * 2 - 9)
    )
    return F.aggregate(sums, F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(_BYTE_PARTS)
    if kind == "card":
        return _luhn(_digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _located(text: Column, pattern: Column, kind: str) -> Column:
    """All leftmost non-overlapping matches with their places.

    What stands between matches comes from splitting by the same pattern, so lengths
    add up to positions. Texts without a match are not split.
    """
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    empty = F.array().cast(f"array<{_SPAN}>")
    pairs = F.arrays_zip(hits.alias("hit"), F.slice(between, 1, F.size(hits)).alias("gap"))
    walk = F.aggregate(
        pairs,
        F.struct(F.lit(0).alias("at"), empty.alias("spans")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).cast("int").alias("at"),
            F.concat(
                acc["spans"],
                F.array(
                    F.struct(
                        F.lit(kind).alias("kind"),
                        (acc["at"] + F.length(x["gap"])).cast("int").alias("start"),
                        (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).cast("int").alias("end"),
                        x["hit"].alias("value"),
                    ).cast(_SPAN)
                ),
            ).alias("spans"),
        ),
    )["spans"]
    return F.when(F.size(hits) > 0, walk).otherwise(empty)


def base_spans(text: Column, kind: str) -> Column:
    needed = {"email": "@", "ip": ".", "phone": "+"}.get(kind)
    found = F.filter(_located(text, F.lit(_PATTERNS[kind]), kind), lambda s: _valid(kind, s["value"]))
    empty = F.array().cast(f"array<{_SPAN}>")
    return F.when(text.contains(needed), found).otherwise(empty) if needed else found


def _entity(span: Column) -> Column:
    return F.concat(span["kind"], F.lit(":"), F.lower(span["value"]))


def _terms(context: Column) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(context), F.lit(_TERM), F.lit(0)), lambda t: F.length(t) >= 3))


def contexts(found: DataFrame, text: str = "text") -> DataFrame:
    """Distinct surroundings of entities: ``entity``, ``text_key`` and the ``terms`` near it.

    A context is up to ``_CONTEXT`` characters on either side within the line, without
    other entities and without words cut at its ends: bounded, however many entities
    and words a document holds.
    """
    spans = found.select(text, F.xxhash64(text).alias("text_key"), F.explode("__spans").alias("s"))
    start, end = F.col("s.start"), F.col("s.end")
    at = F.greatest(F.lit(0), start - _CONTEXT)
    before = F.substring_index(F.substring(F.col(text), at + 1, start - at), "\n", -1)
    before = F.when((at > 0) & (F.length(before) == _CONTEXT), F.regexp_replace(before, r"^\S+", "")).otherwise(before)
    after = F.substring_index(F.substring(F.col(text), end + 1, F.lit(_CONTEXT)), "\n", 1)
    after = F.when(F.length(after) == _CONTEXT, F.regexp_replace(after, r"\S+$", "")).otherwise(after)
    around = F.concat_ws(" ", before, after)
    for kind in KINDS:
        around = F.regexp_replace(around, _PATTERNS[kind], " ")
    return spans.select(_entity(F.col("s")).alias("entity"), "text_key", _terms(around).alias("terms")).distinct()


def disclosures(
    found: DataFrame,
    documents: DataFrame,
    text: str = "text",
    min_support: int = 3,
    generalise_at: float = 0.8,
) -> DataFrame:
    """Pairs of entity and term whose disclosure reaches ``generalise_at``.

    ``found`` holds the documents with spans. Pairs seen near each other in fewer than
    ``min_support`` different texts say nothing.
    """
    near = contexts(found, text)
    pairs = (
        near.select("entity", "text_key", F.explode("terms").alias("term"))
        .distinct()
        .groupBy("entity", "term")
        .agg(F.count("*").alias("n_both"))
        .where(F.col("n_both") >= min_support)
    )
    spark = found.sparkSession
    path = scratch_path(spark, "pairs")
    pairs.write.parquet(path)
    pairs = spark.read.parquet(path)
    if pairs.isEmpty():
        return spark.createDataFrame([], "entity string, term string, disclosure double")
    candidates = pairs.select("term").distinct()
    key = F.xxhash64(text)
    n_all = F.lit(documents.agg(F.count_distinct(key)).first()[0])
    different = documents.groupBy(key.alias("text_key")).agg(F.first(text).alias("__text"))
    words = different.select(F.explode(_terms(F.col("__text"))).alias("term"))
    frequency = counted_terms(words, candidates)
    entity_counts = near.groupBy("entity").agg(F.count_distinct("text_key").alias("n_entity"))
    p_entity = F.col("n_entity") / n_all
    joint = F.col("n_both") * n_all / (F.col("n_entity") * F.greatest("n_term", "n_both"))
    score = F.when(p_entity < 1, F.log2(joint) / -F.log2(p_entity))
    return (
        pairs.join(frequency, "term")
        .join(entity_counts, "entity")
        .select("entity", "term", score.alias("disclosure"))
        .where(F.col("disclosure") >= generalise_at)
    )


def counted_terms(words: DataFrame, candidates: DataFrame) -> DataFrame:
    """``n_term`` of the candidate terms among ``words`` (one row per occurrence).

    Counted and written before they meet the candidates: a join on the grouping key
    would otherwise be pushed below the count, and meet every occurrence of a term.
    """
    spark = words.sparkSession
    counted = scratch_path(spark, "term-counts")
    words.groupBy("term").agg(F.count("*").alias("n_term")).write.parquet(counted)
    return spark.read.parquet(counted).join(candidates, "term", "left_semi")


def _any_of(terms: Column) -> Column:
    """A pattern for whole terms, longest first where one begins another."""
    quoted = F.transform(
        F.array_sort(terms, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0)),
        lambda t: F.concat(F.lit(r"\Q"), t, F.lit(r"\E")),
    )
    return F.concat(
        F.lit(f"(?iu)(?<!{_NOT_IN_WORD})(?:"), F.array_join(quoted, "|"), F.lit(f")(?!{_NOT_IN_WORD})")
    )


def find_spans(
    documents: DataFrame,
    text: str = "text",
    min_support: int = 3,
    generalise_at: float = 0.8,
    remove_at: float = 0.9,
    keep_text: bool = True,
) -> DataFrame:
    """All rows with ``spans`` (kind, start, end, value, sorted), ``base_spans`` and ``removed_terms``.

    With ``keep_text=False`` only texts that hold spans are kept, which is all that
    the second look needs.
    """
    documents = without(documents, "spans", "base_spans", "removed_terms")
    spark = documents.sparkSession
    value = F.coalesce(F.col(text), F.lit(""))
    per_kind = documents.withColumn("__text", value)
    per_kind = per_kind.select("*", *[base_spans(F.col("__text"), k).alias(f"__{k}") for k in KINDS])
    located = per_kind.withColumn("__spans", F.concat(*[F.col(f"__{k}") for k in KINDS])).drop(
        "__text", *[f"__{k}" for k in KINDS]
    )
    if not keep_text:
        located = located.withColumn(text, F.when(F.size("__spans") > 0, F.col(text)))
    path = scratch_path(spark, "spans")
    located.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    found = rows.where(F.size("__spans") > 0)
    revealing = disclosures(found, documents, text, min_support, generalise_at)
    scratch = scratch_path(spark, "revealing")
    revealing.write.parquet(scratch)
    revealing = spark.read.parquet(scratch)
    entities = found.select("__row", F.explode(F.array_distinct(F.transform("__spans", _entity))).alias("entity"))
    per_row = (
        entities.join(revealing, "entity")
        .groupBy("__row", "term")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy("__row")
        .agg(
            F.collect_list("term").alias("__terms"),
            F.collect_list(F.when(F.col("disclosure") >= remove_at, F.col("term"))).alias("__removed"),
        )
    )
    more = found.join(per_row, "__row").withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    hits = _located(F.col("__text"), _any_of(F.col("__terms")), TERM)
    free = F.filter(
        hits, lambda h: ~F.exists("__spans", lambda s: (s["start"] < h["end"]) & (h["start"] < s["end"]))
    )
    extra = more.select("__row", free.alias("__found"), "__removed")
    names = documents.columns
    joined = rows.join(extra, "__row", "left")
    return joined.select(
        *names,
        F.col("__spans").alias("base_spans"),
        F.when(F.col("__found").isNull(), F.col("__spans")).otherwise(F.concat("__spans", "__found")).alias("spans"),
        F.coalesce(F.col("__removed"), F.array().cast("array<string>")).alias("removed_terms"),
    )


def n_spans(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def sanitise(found: DataFrame, text: str = "text") -> DataFrame:
    """Texts with spans replaced by class names, removed terms left out. Other columns stay.

    Where spans of different kinds overlap, the one that begins first (then the longer)
    is replaced and the rest of an overlapping one goes with it.
    """
    tag = lambda s: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in TAGS.items() for x in kv]), s["kind"]), F.lit(TERM_TAG))
    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s["value"].alias("value"))))
    step = lambda acc, s: F.struct(
        F.greatest(acc["at"], -s["back"]).cast("int").alias("at"),
        F.when(
            s["start"] >= acc["at"],
            F.concat(
                acc["out"],
                F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]),
                F.when(F.array_contains("removed_terms", F.lower(s["value"])) & (s["kind"] == TERM), F.lit("")).otherwise(tag(s)),
            ),
        ).otherwise(acc["out"]).alias("out"),
    )
    rewritten = F.aggregate(
        ordered,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))),
    )
    new = F.when(F.size("spans") > 0, rewritten).otherwise(F.col(text))
    names = [c for c in found.columns if c not in ("spans", "base_spans", "removed_terms")]
    return found.select(*[new.alias(text) if c == text else F.col(c) for c in names])
