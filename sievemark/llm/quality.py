"""Quality rules as a decision list learnt from labelled statistics.

Everything is DataFrame work: features are built-in expressions, the learner sees
only counts per feature and threshold, and the result is one ordered Spark
conditional expression.

Defined cases: a null or empty text has all features 0; labels that are null or of
unknown documents count for nothing; without low-quality labels the list is empty and
keeps everything; repeated rows are judged like others; an empty table gives an empty
result; extra columns pass through, names beginning with ``__`` are reserved.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.columns import without
from sievemark.llm.scratch import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
_SPACES = " \t\n\x0b\x0c\r"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What rules may test; all are shares or means, so that they do not follow the length.
FEATURES = (
    "words", "word_length", "symbol_share", "dup_line_share", "repeat_share", "capital_share", "exclaim_share", "distinct_share"
)


def _count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0)).cast("double")


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts ``n_words word_chars n_symbols n_dup_lines n_repeat_words`` and the ``FEATURES``.

    A word is in a repeated window if any 3-word window over it occurs twice: window
    hashes are sorted within the row, equal neighbours give the places, and the places
    give the words covered. Rows without a repeated window skip that.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    documents = without(documents, *counts, *FEATURES)
    kept = documents.columns
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(WORD))
    words = F.filter(F.split(value, SPACE), lambda word: word != "")
    first = documents.select(*kept, value.alias("__t"), words.alias("__w"), lines.alias("__l"))
    n = F.size("__w").cast("long")
    word = F.col("__w")
    windows = F.when(
        n >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size("__w") - 3),
            lambda i: F.xxhash64(F.get(word, i), F.get(word, i + 1), F.get(word, i + 2)),
        ),
    )
    counted = first.select(
        *kept,
        n.alias("n_words"),
        F.length(F.translate("__t", _SPACES, "")).cast("long").alias("word_chars"),
        _count_of(F.col("__t"), SYMBOLS).cast("long").alias("n_symbols"),
        F.size("__l").cast("long").alias("__lines"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("__w")).cast("long").alias("__distinct"),
        _count_of(F.col("__t"), _CAPITALS).alias("__capitals"),
        _count_of(F.col("__t"), "!").alias("__exclaims"),
        windows.alias("__h"),
    )
    hashes = F.col("__h")
    repeated = F.size(F.array_distinct(hashes)) < F.size(hashes)
    ordered = F.when(repeated, F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    ranked = counted.withColumn("__s", ordered).drop("__h")
    s = F.col("__s")
    same = F.filter(
        s,
        lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        | ((i > 0) & F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))),
    )
    placed = ranked.withColumn("__p", F.array_sort(F.transform(same, lambda x: x["i"]))).drop("__s")
    p = F.col("__p")
    covered = F.aggregate(
        F.transform(p, lambda at, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - at, F.lit(3)))),
        F.lit(0),
        lambda total, x: total + x,
    )
    done = placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    words_n, chars = F.col("n_words"), F.col("word_chars")
    features = (
        words_n.cast("double"),
        _share(chars, words_n),
        _share(F.col("n_symbols"), chars),
        _share(F.col("n_dup_lines"), F.col("__lines")),
        _share(F.col("n_repeat_words"), words_n),
        _share(F.col("__capitals"), chars),
        _share(F.col("__exclaims"), words_n),
        _share(F.col("__distinct"), words_n),
    )
    return done.select(*kept, *counts, *[f.alias(name) for f, name in zip(features, FEATURES)])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # at least the threshold, else below it
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(conditions: Rule) -> Column:
    return reduce(lambda a, b: a & b, [c.column() for c in conditions], F.lit(True))


def learn(
    labelled: DataFrame,
    label: str = "quality",
    order: str = "doc_id",
    max_rules: int = 8,
    max_conditions: int = 3,
    bins: int = 32,
    min_support: int = 5,
    min_precision: float = 0.9,
) -> list[Rule]:
    """Sequential covering over rows with ``FEATURES`` and a 0/1 ``label`` (0: reject).

    Two thirds of the rows grow rules, one third prunes them. A rule grows by the
    condition of highest information gain, is cut back to the prefix that does best on
    the pruning rows, and is accepted if its smoothed precision there reaches
    ``min_precision``. Each step reads one table of counts: features x bins rows,
    whatever the number of documents.
    """
    rows = labelled.where(F.col(label).isin(0, 1))
    edges_of = rows.select(
        *[F.percentile_approx(f, [i / bins for i in range(1, bins)], 10_000).alias(f) for f in FEATURES]
    ).first()
    edges = {f: sorted(set(edges_of[f] or [])) for f in FEATURES}
    fold = F.crc32(F.coalesce(F.col(order).cast("string"), F.lit(""))) % 3
    bad = (F.col(label) == 0).cast("long")
    binned = rows.select(
        *FEATURES,
        bad.alias("__bad"),
        (fold == 2).alias("__prune"),
        *[_bin(F.col(f), edges[f]).alias(f"__b_{f}") for f in FEATURES],
    )
    path = scratch_path(labelled.sparkSession, "labelled")
    binned.write.parquet(path)
    binned = labelled.sparkSession.read.parquet(path)
    rules: list[Rule] = []
    open_rows = binned
    while len(rules) < max_rules:
        rule = _grow(open_rows.where(~F.col("__prune")), edges, max_conditions, min_support)
        rule = _prune(open_rows.where(F.col("__prune")), rule, min_support, min_precision)
        if not rule:
            break
        rules.append(rule)
        open_rows = open_rows.where(~_all(rule))
    return rules


def _bin(value: Column, edges: list[float]) -> Column:
    """How many edges the value reaches."""
    return reduce(lambda a, b: a + b, [(value >= e).cast("int") for e in edges], F.lit(0))


def _histogram(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f"__b_{f}").alias("b")) for f in FEATURES]))
    counts = rows.select(cells.alias("c"), "__bad").groupBy("c").agg(F.sum("__bad").alias("bad"), F.count("*").alias("n"))
    out: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
    for row in counts.collect():
        out[row["c"]["f"]][row["c"]["b"]] = (row["bad"], row["n"] - row["bad"])
    return out


def _grow(rows: DataFrame, edges: dict[str, list[float]], max_conditions: int, min_support: int) -> Rule:
    import math

    rule: list[Condition] = []
    while len(rule) < max_conditions:
        table = _histogram(rows.where(_all(tuple(rule))))
        any_feature = table[FEATURES[0]].values()
        bad, good = sum(b for b, _ in any_feature), sum(g for _, g in any_feature)
        if not bad or not good:
            break
        base = math.log2(bad / (bad + good))
        best: tuple[float, Condition] | None = None
        for feature in FEATURES:
            below_bad = below_good = 0
            for i, edge in enumerate(edges[feature]):
                cell = table[feature].get(i, (0, 0))
                below_bad, below_good = below_bad + cell[0], below_good + cell[1]
                for above, p, n in ((True, bad - below_bad, good - below_good), (False, below_bad, below_good)):
                    if p >= min_support and (p, n) != (bad, good):
                        gain = p * (math.log2(p / (p + n)) - base)
                        if best is None or gain > best[0]:
                            best = (gain, Condition(feature, above, float(edge)))
        if best is None or best[0] <= 0:
            break
        rule.append(best[1])
    return tuple(rule)


def _prune(rows: DataFrame, rule: Rule, min_support: int, min_precision: float) -> Rule:
    if not rule:
        return ()
    sums = []
    for k in range(1, len(rule) + 1):
        hit = _all(rule[:k]).cast("long")
        sums += [F.sum(hit * F.col("__bad")).alias(f"p{k}"), F.sum(hit).alias(f"n{k}")]
    counts = rows.agg(*sums).first()
    worth = [((counts[f"p{k}"] or 0) + 1) / ((counts[f"n{k}"] or 0) + 2) for k in range(1, len(rule) + 1)]
    k = max(range(len(rule)), key=lambda i: (worth[i], -i))
    enough = (counts[f"p{k + 1}"] or 0) >= max(1, min_support // 2)
    # Few pruning rows cannot reach the bar by themselves; without a single error they pass.
    clean = counts[f"p{k + 1}"] == counts[f"n{k + 1}"]
    return rule[: k + 1] if enough and (clean or worth[k] >= min_precision) else ()


def verdict(rules: list[Rule]) -> Column:
    """The list as an ordered conditional: the number of the first rule that fires, else null."""
    if not rules:
        return F.lit(None).cast("int")
    out = F.when(_all(rules[0]), F.lit(1))
    for number, rule in enumerate(rules[1:], start=2):
        out = out.when(_all(rule), F.lit(number))
    return out


def described(rules: list[Rule]) -> list[str]:
    return [" and ".join(map(str, rule)) for rule in rules]


def judge(
    documents: DataFrame, labels: DataFrame, text: str = "text", order: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """Counts, features, ``rule`` (null: none fired) and ``method_keeps`` for every document.

    Features are written once, without the texts; learning and judging read them.
    """
    spark = documents.sparkSession
    documents = without(documents, "rule", "method_keeps")
    path = scratch_path(spark, "features")
    with_counts(documents, text).drop(text).write.parquet(path)
    features = spark.read.parquet(path)
    known = labels.select(F.col(order).alias("__id"), F.col(label).alias("__label"))
    rules = learn(
        features.select(order, *FEATURES).join(known, F.col(order) == F.col("__id")), label="__label", order=order
    )
    return features.withColumn("rule", verdict(rules)).withColumn("method_keeps", F.col("rule").isNull())
