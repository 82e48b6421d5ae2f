"""Document fingerprints by SpotSigs: chains of content words behind common words.

Words are runs of anything but white space and ASCII punctuation, A-Z taken as a-z. Every
occurrence of an anchor (a common function word), and the beginning of the text, spots
the next content words; anchor and chain hash to one 32-bit signature. The fingerprint
is the sorted set of signatures in base64: equal texts have equal fingerprints, and a
local edit changes only the chains around it. Likeness is the Jaccard coefficient.

A search assigns fingerprints to partitions by set length, such that two sets of the
wanted likeness lie in the same or in adjacent partitions, meets them on their rarest
signatures only, and stops comparing where the lengths, or what is left of both sets,
rule the likeness out.

Defined cases: a text in which no anchor has content words behind it (another language,
a list of names) spots a chain at every content word instead, so that its signatures
cover it to its end; a null text counts as empty; a text without content words has one
signature, the hash of the whole text; rows without an id come first in the order,
rows of one id follow by text; an empty table gives an empty result; extra columns are
not carried along.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.texts import PUNCTUATED, document_words, hash_of, mixed

# Common function words of English, German, Spanish and French.
ANCHORS = tuple(
    "the of and to in a is that it for on was as be with by this are at an from or but not have has he she they we you "
    "der die das und den von zu mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass "
    "el la los las de que y en un una por con para se del al lo como más pero su sus es "
    "le les et des du une pour dans qui sur ne pas au plus par il elle avec ce se".split()
)
CHAIN = 2

_generator = np.random.default_rng(4711)
_STEP = _generator.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_START = np.uint64(0x5374617274)
_EVERY = np.uint64(0x4576657279)


@lru_cache(maxsize=4)
def _anchor_hashes(anchors: tuple[str, ...]) -> np.ndarray:
    return np.array(sorted({hash_of(a) for a in anchors}), dtype=np.uint64)


def signature_sets(column: pa.Array, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> Iterator[np.ndarray]:
    """Sorted distinct 32-bit signatures of each text of a column."""
    known = _anchor_hashes(anchors)
    for first, words, bounds in document_words(column, separators=PUNCTUATED):
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        spot = known[at] == words
        content = words[~spot]
        before = np.concatenate([[0], np.cumsum(~spot)])  # content words before each word
        document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        last = before[bounds[1:]]  # content words up to each document's end
        anchors_at = np.flatnonzero(spot)
        owner = np.concatenate([document[anchors_at], np.arange(len(bounds) - 1)])
        value = np.concatenate([words[anchors_at], np.full(len(bounds) - 1, _START)]) * _STEP[0]
        follow = np.concatenate([before[anchors_at + 1], before[bounds[:-1]]])
        filled = follow < last[owner]
        spotted = np.zeros(len(bounds) - 1, dtype=bool)
        spotted[owner[: len(anchors_at)][filled[: len(anchors_at)]]] = True
        holder = document[~spot]
        every = np.flatnonzero(~spotted[holder])
        owner = np.concatenate([owner[filled], holder[every]])
        value = np.concatenate([value[filled], np.full(len(every), _EVERY) * _STEP[0]])
        follow = np.concatenate([follow[filled], every])
        for k in range(chain):
            there = follow + k < last[owner]
            step = np.where(there, content[np.minimum(follow + k, max(0, len(content) - 1))], np.uint64(0)) if len(content) else np.zeros(len(owner), np.uint64)
            value = value + step * _STEP[k + 1]
        signatures = (mixed(value) >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((signatures, owner))
        owner, signatures = owner[order], signatures[order]
        fresh = np.ones(len(owner), dtype=bool)
        fresh[1:] = (owner[1:] != owner[:-1]) | (signatures[1:] != signatures[:-1])
        owner, signatures = owner[fresh], signatures[fresh]
        cuts = np.searchsorted(owner, np.arange(len(bounds)))
        for i, (begin, end) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
            yield signatures[begin:end] if end > begin else _whole(column[first + i].as_py())


def _whole(text: str | None) -> np.ndarray:
    digest = hashlib.blake2b((text or "").encode(), digest_size=4).digest()
    return np.frombuffer(digest, dtype="<u4").astype(np.uint32)


def written(signatures: np.ndarray) -> str:
    return base64.b64encode(signatures.astype("<u4").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u4")


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard coefficient of two sorted sets; 0 where their lengths rule ``at_least`` out."""
    if min(len(a), len(b)) < at_least * max(len(a), len(b)):
        return 0.0
    if len(a) == len(b) and (a == b).all():
        return 1.0
    place = np.searchsorted(b, a)
    common = int((b[np.minimum(place, len(b) - 1)] == a).sum()) if len(b) else 0
    value = common / (len(a) + len(b) - common)
    return value if value >= at_least else 0.0


def fingerprints(documents: DataFrame, order: str = "doc_id", text: str = "text", anchors: Sequence[str] = ANCHORS) -> DataFrame:
    """``order``, ``n_signatures`` and ``fingerprint`` of every document."""
    chosen, kind = tuple(anchors), documents.schema[order].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(signature_sets(batch.column(1), chosen))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([written(s) for s in sets], pa.string())],
                names=[order, "n_signatures", "fingerprint"],
            )

    return documents.select(order, text).mapInArrow(run, f"`{order}` {kind}, n_signatures long, fingerprint string")


def successions(documents: DataFrame, order: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """``bucket, extra, id, text``: documents in ranges of ascending ids, each range followed by its successor.

    Range bounds are ids that occur, so the document a range continues with is known
    from its id alone; it is sent to both ranges. Behind the last id comes the first.
    Texts move once.
    """
    spark = documents.sparkSession
    wanted = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.coalesce(F.col(order).cast("long"), F.lit(-(1 << 63)))
    chosen = documents.select(place.alias("__place"), F.col(order).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    shares = [i / wanted for i in range(wanted)]
    found = chosen.agg(F.percentile_approx("__place", shares, 20 * wanted).alias("q"), F.min("__place").alias("low")).first()
    bounds = np.array(sorted({*(found["q"] or []), *([] if found["low"] is None else [found["low"]])}), dtype=np.int64)

    @F.pandas_udf("bucket int, before int")
    def bucket(ids: pd.Series) -> pd.DataFrame:
        values = ids.to_numpy()
        at = np.searchsorted(bounds, values, side="right") - 1
        leads = bounds[at] == values
        return pd.DataFrame({"bucket": at.astype(np.int32), "before": np.where(leads, (at - 1) % len(bounds), -1).astype(np.int32)})

    placed = chosen.withColumn("__b", bucket("__place"))
    both = F.array(
        F.struct(F.col("__b.bucket").alias("bucket"), F.lit(False).alias("extra")),
        F.when(F.col("__b.before") >= 0, F.struct(F.col("__b.before").alias("bucket"), F.lit(True).alias("extra"))),
    )
    copies = placed.withColumn("__c", F.explode(F.array_compact(both)))
    flat = copies.select(F.col("__c.bucket").alias("bucket"), F.col("__c.extra").alias("extra"), "__place", "id", "text")
    return flat.repartition("bucket").sortWithinPartitions("bucket", "extra", "__place", "text").drop("__place")


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points give way to as many of the following text's first ones."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_edits(documents: DataFrame, order: str = "doc_id", text: str = "text", anchors: Sequence[str] = ANCHORS) -> DataFrame:
    """Fingerprints of every document and of its edited text, and the likeness to that and to the next document."""
    chosen = tuple(anchors)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = None  # the last row so far: bucket, extra, id, text, set
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = signature_sets(part.column("text"), chosen)
                rows = list(zip(*(part.column(c).to_pylist() for c in ("bucket", "extra", "id", "text")), sets))
                if waiting is not None:
                    rows.insert(0, waiting)
                waiting = rows[-1]
                pairs = [(a, b) for a, b in zip(rows, rows[1:]) if not a[1] and a[0] == b[0]]
                if not pairs:
                    continue
                texts = [edited(a[3], b[3]) for a, b in pairs]
                after = list(signature_sets(pa.array(texts, pa.string()), chosen))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([a[2] for a, _ in pairs], pa.int64()),
                        pa.array([len(a[3]) for a, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                        pa.array([written(a[4]) for a, _ in pairs], pa.string()),
                        pa.array([written(s) for s in after], pa.string()),
                        pa.array([likeness(a[4], s) for (a, _), s in zip(pairs, after)], pa.float64()),
                        pa.array([likeness(a[4], b[4]) for a, b in pairs], pa.float64()),
                    ],
                    names=names,
                )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return successions(documents, order, text).mapInArrow(run, schema)


def length_partition(n: Column, at_least: float) -> Column:
    """Number of the partition for sets of length ``n``: each spans one factor of ``1 / at_least``."""
    return F.floor(F.log(F.greatest(n, F.lit(1)).cast("double")) / F.lit(-float(np.log(at_least)))).cast("int")


def search(prints: DataFrame, queries: DataFrame, at_least: float = 0.8, order: str = "doc_id") -> DataFrame:
    """``query_id, id, likeness`` of all fingerprints at least that like a query's (itself excluded).

    ``prints`` and ``queries`` have ``order``, ``n_signatures`` and ``fingerprint``. Equal
    fingerprints are compared once. Two sets of that likeness share one of the rarest
    floor((1 - at_least) * n) + 1 signatures of each, so only those meet, and only
    in the same or an adjacent length partition.
    """

    @F.pandas_udf("array<long>")
    def opened(values: pd.Series) -> pd.Series:
        return values.map(lambda f: read(f).astype(np.int64))

    @F.pandas_udf("double")
    def jaccard(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([likeness(read(x), read(y), at_least) for x, y in zip(a, b)], dtype="float64")

    distinct = prints.groupBy("fingerprint").agg(F.first("n_signatures").alias("n"))
    exploded = distinct.select("fingerprint", "n", F.explode(opened("fingerprint")).alias("sig"))
    counts = exploded.groupBy("sig").agg(F.count("*").alias("df"))

    def rarest(rows: DataFrame) -> DataFrame:
        known = rows.select("fingerprint", "n", F.explode(opened("fingerprint")).alias("sig")).join(counts, "sig")
        listed = known.groupBy("fingerprint", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sig"))).alias("s"))
        head = F.transform(F.slice("s", 1, F.floor((1 - at_least) * F.col("n") + 1e-9).cast("int") + 1), lambda x: x["sig"])
        return listed.select("fingerprint", "n", length_partition(F.col("n"), at_least).alias("part"), F.explode(head).alias("sig"))

    asked = queries.groupBy("fingerprint").agg(F.first("n_signatures").alias("n"))
    left = rarest(asked).select(F.col("fingerprint").alias("qf"), F.explode(F.array(F.col("part") - 1, "part", F.col("part") + 1)).alias("part"), "sig")
    pairs = left.join(rarest(distinct), ["part", "sig"]).select("qf", F.col("fingerprint").alias("f")).distinct()
    near = pairs.withColumn("likeness", jaccard("qf", "f")).where(F.col("likeness") >= at_least)
    return (
        near.join(queries.select(F.col(order).alias("query_id"), F.col("fingerprint").alias("qf")), "qf")
        .join(prints.select(F.col(order).alias("id"), F.col("fingerprint").alias("f")), "f")
        .where(F.col("id") != F.col("query_id"))
        .select("query_id", "id", "likeness")
    )
