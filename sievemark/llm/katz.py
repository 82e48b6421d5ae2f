"""A Katz back-off model of pairs or triples: counted, normalised and applied in partitioned tables.

Tokens are words ``[^\\x20\\x09-\\x0D]+`` (A-Z taken as a-z) and one end per text. With ``length=3,
pooled=False`` all pairs and triples of words are counted, however rare:

    P(c | a b) = d3(n) * n(a b c) / n(a b)   if the triple occurred n times in training
               = alpha(a b) * P(c | b)       if only its context a b did
               = P(c | b)                    otherwise
    P(b | a)   = d2(n) * n(a b) / n(a)       if the pair occurred n times in training
               = alpha(a) * P(b)             if only its context a did
               = P(b)                        otherwise

d is the Good-Turing discount of an order for counts up to ``K``, alpha the weight that makes the
probabilities behind a context sum to exactly 1. Single words' counts up to ``K`` are discounted
likewise, and what that frees is the probability of an unseen word, which is a class of its own.

``pooled`` makes a smaller model of classes: words seen at most ``K + 1`` times form one class
with unseen words and keep their own counts within it: P(w | h) = P(class(w) | class(h)) * P(w | class(w)).
``length=2`` leaves the triples out.

Counts live in tables partitioned by the hash of a word or pair. Texts become blocks of
word hashes once; every block asks the partitions of its distinct words for their counts
and so knows the class and share of each. Tasks count pairs first and send one packed row per
partition, so a frequent pair is sent once per block, however often it occurs. Partitions of pairs
send sums per context to the partitions of contexts and get their weights back. As

    log P(b | a) = log alpha(a) + log P(b), plus what a pair seen in training adds

(and likewise for triples), a text's score is a sum over its words, its contexts and its known pairs and
triples, and each partition answers with sums per document. Triples lie with the pair they begin with, so all
that follows a pair is in one place; they ask the partitions of their last pairs for P(c | b). Partitions are asked in ``PASSES`` turns, so that only one turn's
requests lie on disk at a time. No words but the most frequent (at most ``VOCABULARY``) are
broadcast, with their weights: those need not be asked for, which changes no result.

Defined cases: a null or empty text has the end token only; with no training document
every probability comes from the smoothed class shares; repeated rows count and score
each; an empty table gives an empty result; extra columns are not carried along.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm.texts import document_words, mixed
from sievemark.llm.scratch import remove, scratch_path
from sievemark.session import setting

VOCABULARY = 65_000
K = 5
BLOCK_TOKENS = 2_000_000
BLOCK_DOCUMENTS = 4096
STRETCH_TOKENS = 1 << 18
PART_TOKENS = 1 << 21
PASSES = 4

# Codes of classes: a most frequent word's rank among them, these three, else a word's id.
_START, _END, _RARE, _IDS = 65_535, 65_534, 65_533, 65_536
_END_HASH = np.uint64(0xE7D5C3B1A9F80246)
_LOG_STEPS = 16


def _pack(values: np.ndarray) -> bytes:
    """Fixed-width values by byte position, compressed, behind their number of bytes and bytes a value
    (of unsigned values those that are not 0 in all)."""
    raw = np.ascontiguousarray(values)
    if not len(raw):
        return b""
    width = max(1, -(-int(raw.max()).bit_length() // 8)) if raw.dtype.kind == "u" else raw.itemsize
    planes = raw.view(np.uint8).reshape(len(raw), raw.itemsize)[:, :width].T.tobytes()
    return len(planes).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(data: bytes, kind: str) -> np.ndarray:
    if not data:
        return np.zeros(0, dtype=kind)
    size, width = int.from_bytes(data[:8], "little"), data[8]
    planes = pa.decompress(memoryview(data)[9:], size, codec="zstd")
    out = np.zeros((size // width, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(planes, np.uint8).reshape(width, -1).T
    return out.view(kind).ravel()


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], np.add.reduceat(counts, starts)


def _exchange(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """Packed counts: partition, keys, counts."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([p for p, _, _ in rows], pa.int32()),
            pa.array([_pack(k) for _, k, _ in rows], pa.binary()),
            pa.array([_pack(c.astype("<u4")) for _, _, c in rows], pa.binary()),
        ],
        names=["p", "keys", "counts"],
    )


def _by_part(keys: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each partition begins among keys sorted by partition, and which partitions those are."""
    starts = np.flatnonzero(np.r_[True, home[1:] != home[:-1]]) if len(home) else np.zeros(0, np.int64)
    return starts, home[starts]


def _sum_tables(partial: DataFrame, kind: str, name: str) -> DataFrame:
    """Merge packed counts of every partition and write the table."""
    schema = pa.schema([("p", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

    def merge(table: pa.Table) -> pa.Table:
        keys = np.concatenate([_unpack(k, kind) for k in table.column("keys").to_pylist()])
        counts = np.concatenate([_unpack(c, "<u4") for c in table.column("counts").to_pylist()]).astype(np.uint64)
        keys, counts = _merged(keys, counts)
        row = {"p": table.column("p")[0].as_py(), "keys": _pack(keys), "counts": _pack(counts)}
        return pa.Table.from_pylist([row], schema)

    spark = partial.sparkSession
    path = scratch_path(spark, name)
    partial.groupBy("p").applyInArrow(merge, "p int, keys binary, counts binary").write.parquet(path)
    return spark.read.parquet(path)


def _training_words(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By chunks: word hashes and bounds of the documents that are not held out."""
    used = ~batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
    for first, hashes, bounds in document_words(batch.column("text")):
        sizes = np.diff(bounds)
        own = used[first : first + len(sizes)]
        kept = sizes[own]
        yield hashes[np.repeat(own, sizes)], np.concatenate([[0], np.cumsum(kept)])


def count_words(documents: DataFrame, parts: int) -> DataFrame:
    """Counts of all training tokens by word hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for hashes, bounds in _training_words(batch):
                waiting += [hashes, np.full(len(bounds) - 1, _END_HASH)]
                size += len(hashes) + len(bounds) - 1
                if size >= 2 * BLOCK_TOKENS:
                    yield flush(waiting)
                    waiting, size = [], 0
        if size:
            yield flush(waiting)

    def flush(waiting: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
        starts, homes = _by_part(keys, _part(keys, parts))
        return _exchange(list(zip(homes.tolist(), np.split(keys, starts[1:]), np.split(counts, starts[1:]))))

    partial = documents.mapInArrow(run, "p int, keys binary, counts binary")
    return _sum_tables(partial, "<u8", "words")


def _buckets(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(counts.astype(np.float64)) * _LOG_STEPS + 1e-9).astype(np.int64)


@dataclass
class Model:
    """What every task needs, of bounded size: the most frequent words and statistics of all."""

    total: int  # N
    distinct: int  # V
    hashes: np.ndarray  # most frequent words, sorted
    word_counts: np.ndarray
    ranks: np.ndarray  # their codes, the most frequent first
    end_count: int
    end_share: float  # P(end)
    rare_share: float  # P(rare)
    rare_discount: np.ndarray  # by count up to K
    rare_log_total: float
    rare_log_unseen: float

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts of the most frequent words, which words are others, and codes of the most frequent words."""
        if not len(self.hashes):
            return np.zeros(len(hashes), dtype=np.int64), np.ones(len(hashes), dtype=bool), np.zeros(len(hashes), np.uint64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        others = self.hashes[at] != hashes
        return np.where(others, 0, self.word_counts[at]), others, np.where(others, np.uint64(0), self.ranks[at])

    def shares(self) -> np.ndarray:
        """Shares of the classes with small codes."""
        out = np.ones(_IDS)
        out[self.ranks.astype(np.int64)] = self.word_counts / (self.total + 2.0)
        out[_END], out[_RARE] = self.end_share, self.rare_share
        return out

    def share(self, counts: np.ndarray) -> np.ndarray:
        """P(w) by training count."""
        return np.where(counts > K + 1, counts / (self.total + 2.0), self.rare_share * 10 ** self.rare_log(counts))

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.total + self.distinct + 1.0))

    def rare_log(self, counts: np.ndarray) -> np.ndarray:
        """log10 P(w | rare) by training count."""
        factor = self.rare_discount[np.minimum(counts, K + 1).astype(np.int64)]
        with np.errstate(divide="ignore"):
            known = np.log10(factor * counts) - self.rare_log_total
        return np.where(counts > 0, known, self.rare_log_unseen)


def discounts(n: dict[int, int]) -> np.ndarray:
    """Good-Turing discounts of counts 0 to K+1 (the last stands for all larger), from numbers of
    items per count. Where Katz's formula leaves (0, 1] a smaller K is tried, at last
    absolute discounting by n1 / (n1 + 2 n2)."""
    out = np.ones(K + 2)
    for k in range(K, 0, -1):
        if not all(n.get(r, 0) for r in range(1, k + 2)):
            continue
        rest = (k + 1) * n[k + 1] / n[1]
        if rest >= 1:
            continue
        found = [((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) for r in range(1, k + 1)]
        if all(0 < d <= 1 for d in found):
            out[1 : k + 1] = found
            return out
    cut = n.get(1, 0) / (n.get(1, 0) + 2 * n.get(2, 0)) if n.get(1, 0) else 0.5
    r = np.arange(1, K + 1)
    out[1 : K + 1] = (r - min(cut, 0.9)) / r
    return out


def vocabulary(words: DataFrame) -> Model:
    """The most frequent words and the statistics of all, from the table of word counts."""

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, packed in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                counts = _unpack(packed, "<u8")[_unpack(raw, "<u8") != _END_HASH]
                if len(counts):
                    bucket, place = np.unique(_buckets(counts), return_inverse=True)
                    sums = np.zeros(len(bucket), dtype=np.int64)
                    np.add.at(sums, place, counts.astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket), pa.array(np.bincount(place)), pa.array(sums)], names=["bucket", "n", "tokens"]
                    )

    by_size = words.mapInArrow(histogram, "bucket long, n long, tokens long").groupBy("bucket")
    rows = sorted(by_size.agg(F.sum("n").alias("n"), F.sum("tokens").alias("t")).collect(), reverse=True)
    # Words seen at most K + 1 times are always rare: their numbers say how likely unseen words are.
    least = int(_buckets(np.array([K + 2]))[0])
    taken, limit = 0, 1 << 40
    for row in rows:
        if taken + row["n"] > VOCABULARY or row["bucket"] < least:
            break
        taken, limit = taken + row["n"], row["bucket"]

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, packed in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
                keys, counts = _unpack(raw, "<u8"), _unpack(packed, "<u8")
                chosen = (_buckets(counts) >= limit) | (keys == _END_HASH)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[chosen].view(np.int64)), pa.array(counts[chosen].astype(np.int64))], names=["key", "n"]
                )

    found = words.mapInArrow(frequent, "key long, n long").toPandas()
    keys, counts = found["key"].to_numpy().astype(np.int64).view(np.uint64), found["n"].to_numpy().astype(np.int64)
    is_end = keys == _END_HASH
    end_count = int(counts[is_end].sum())
    order = np.argsort(keys[~is_end])
    keys, counts = keys[~is_end][order], counts[~is_end][order]
    rare_rows = [r for r in rows if r["bucket"] < least]
    rare = sum(r["t"] for r in rare_rows)
    total = sum(r["t"] for r in rows) + end_count
    ranks = np.empty(len(counts), np.uint64)
    ranks[np.argsort(-counts, kind="stable")] = np.arange(len(counts), dtype=np.uint64)
    of_count = {r: next((x["n"] for x in rare_rows if x["bucket"] == int(_buckets(np.array([r]))[0])), 0) for r in range(1, K + 2)}
    cut = discounts(of_count)
    freed = sum((1 - cut[r]) * r * of_count[r] for r in range(1, K + 1))
    if freed < 1:  # too little to learn from: one count for the unseen word
        cut, rare_total, unseen = np.ones(K + 2), rare + 1.0, 1.0
    else:
        rare_total, unseen = float(rare), freed
    # One count more for the end and for rare words: both are possible before any was seen.
    return Model(
        total=total, distinct=sum(r["n"] for r in rows) + (end_count > 0), hashes=keys, word_counts=counts, ranks=ranks, end_count=end_count,
        end_share=(end_count + 1) / (total + 2.0), rare_share=(rare + 1) / (total + 2.0), rare_discount=cut,
        rare_log_total=float(np.log10(rare_total)), rare_log_unseen=float(np.log10(unseen / rare_total)),
    )


_BLOCK = "block long, words binary, places binary, sizes binary, ids array<long>, held array<boolean>"
_CODED = (
    "block long, codes binary, counts binary, places binary, sizes binary, ids array<long>, held array<boolean>, "
    "known binary, base binary, score binary"
)


def _written(table: DataFrame, name: str, *read: DataFrame) -> DataFrame:
    """The table, written; own tables that nothing else will read (``read``) are removed."""
    spark = table.sparkSession
    path = scratch_path(spark, name)
    table.write.parquet(path)
    for done in read:
        for folder in {file.rsplit("/", 1)[0] for file in done.inputFiles()}:
            remove(spark, folder)
    return spark.read.parquet(path)


def write_blocks(documents: DataFrame) -> DataFrame:
    """The documents (``id, held, text``) by blocks: distinct word hashes, and the place of each word among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        waiting: list[tuple] = []
        n_docs = n_tokens = 0
        for batch in batches:
            ids = batch.column("id").to_pylist()
            held = batch.column("held").to_pylist()
            for first, hashes, bounds in document_words(batch.column("text")):
                n = len(bounds) - 1
                waiting.append((ids[first : first + n], held[first : first + n], hashes, np.diff(bounds)))
                n_docs, n_tokens = n_docs + n, n_tokens + len(hashes)
                if n_docs >= BLOCK_DOCUMENTS or n_tokens >= BLOCK_TOKENS:
                    yield flush(block, waiting)
                    block, waiting, n_docs, n_tokens = block + 1, [], 0, 0
        if waiting:
            yield flush(block, waiting)

    def flush(block: int, waiting: list[tuple]) -> pa.RecordBatch:
        words, places = np.unique(np.concatenate([w[2] for w in waiting]), return_inverse=True)
        row = {
            "block": block, "words": _pack(words), "places": _pack(places.astype("<u4")),
            "sizes": _pack(np.concatenate([w[3] for w in waiting]).astype("<u4")),
            "ids": [i for w in waiting for i in w[0]], "held": [h for w in waiting for h in w[1]],
        }
        return pa.RecordBatch.from_pylist([row], _arrow(_BLOCK))

    return _written(documents.mapInArrow(run, _BLOCK), "blocks")


def code_words(blocks: DataFrame, words: DataFrame, model: Model, parts: int, pooled: bool = True) -> DataFrame:
    """The blocks with class and share of each word, and per document what its words alone say."""
    shared = blocks.sparkSession.sparkContext.broadcast(model)
    asked_schema, answer_schema = "p int, block long, at binary, keys binary", "block long, at binary, counts binary, ids binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys = _unpack(row["words"], "<u8")
                at = np.flatnonzero(shared.value.known(keys)[1])
                home = _part(keys[at], parts)  # words are sorted, so are their partitions
                starts, homes = _by_part(keys[at], home)
                for p, own in zip(homes.tolist(), np.split(at, starts[1:])):
                    found = {"p": p, "block": row["block"], "at": _pack(own.astype("<u4")), "keys": _pack(keys[own])}
                    yield pa.RecordBatch.from_pylist([found], _arrow(asked_schema))

    def answer(asked: pa.Table, word_rows: pa.Table) -> pa.Table:
        rows = word_rows.to_pylist()
        keys, counts = (_unpack(rows[0][name], "<u8") if rows else np.zeros(0, "<u8") for name in ("keys", "counts"))
        # Ids are the smaller the more frequent a word is, and different in all partitions.
        ids = np.empty(len(keys), np.uint64)
        ids[np.argsort(-counts.astype(np.int64), kind="stable")] = np.arange(len(keys), dtype=np.uint64)
        ids = ids * np.uint64(parts) + np.uint64(_IDS + (rows[0]["p"] if rows else 0))
        counts, ids, out = _Lookup(keys, counts), _Lookup(keys, ids), []
        for row in asked.to_pylist():
            own = _unpack(row["keys"], "<u8")
            found = [_pack(table.values_of(own).astype("<u8")) for table in (counts, ids)]
            out.append({"block": row["block"], "at": row["at"], "counts": found[0], "ids": found[1]})
        return pa.Table.from_pylist(out, _arrow(answer_schema))

    def code(block_rows: pa.Table, answers: pa.Table) -> pa.Table:
        own = shared.value
        row = block_rows.to_pylist()[0]
        keys, places, sizes = _unpack(row["words"], "<u8"), _unpack(row["places"], "<u4"), _unpack(row["sizes"], "<u4").astype(np.int64)
        counts, _, codes = own.known(keys)
        for found in answers.to_pylist():
            at = _unpack(found["at"], "<u4")
            counts[at], codes[at] = _unpack(found["counts"], "<u8"), _unpack(found["ids"], "<u8")
        docs, n = np.repeat(np.arange(len(sizes)), sizes), len(sizes)
        rare = counts <= K + 1
        shares = np.where(rare, own.rare_share, counts / (own.total + 2.0))
        logs = np.log10(shares) + np.where(rare, own.rare_log(counts), 0.0)
        known = np.bincount(docs, weights=(counts > 0)[places], minlength=n).astype(np.int64) + (own.end_count > 0)
        base = np.bincount(docs, weights=own.base(counts)[places], minlength=n) + own.base(np.array([own.end_count]))[0]
        score = np.bincount(docs, weights=logs[places], minlength=n) + np.log10(own.end_share)
        coded = {
            **{name: row[name] for name in ("block", "places", "sizes", "ids", "held")},
            "codes": _pack(np.where(rare if pooled else counts == 0, np.uint64(_RARE), codes)), "counts": _pack(counts.astype("<u8")), "known": _pack(known.astype("<i8")),
            "base": _pack(base), "score": _pack(score),
        }
        return pa.Table.from_pylist([coded], _arrow(_CODED))

    asked = blocks.select("block", "words").mapInArrow(ask, asked_schema)
    answers = asked.groupBy("p").cogroup(words.groupBy("p")).applyInArrow(answer, answer_schema)
    return _written(blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(code, _CODED), "coded", blocks, words)


def _tokens(row: dict, used: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Of a coded block all classes, sorted, and of all tokens the class before, their own, the class behind (as places
    among the sorted) and the document. A document's first token follows the start, its end is the last; behind the end
    stands the start, where nothing is. ``used`` chooses documents."""
    alphabet, ranks = np.unique(np.r_[_unpack(row["codes"], "<u8"), np.array([_START, _END], "<u8")], return_inverse=True)
    places, sizes = _unpack(row["places"], "<u4"), _unpack(row["sizes"], "<u4").astype(np.int64)
    if used is not None:
        places, sizes = places[np.repeat(used, sizes)], sizes[used]
    n = len(places) + len(sizes)
    ends = np.cumsum(sizes + 1) - 1
    inner = np.ones(n, dtype=bool)
    inner[ends] = False
    line = np.full(n, ranks[-1], dtype=np.uint32)
    line[inner] = ranks[places]
    before, behind = np.roll(line, 1), np.roll(line, -1)
    before[ends - sizes] = behind[ends] = ranks[-2]
    return alphabet, before, line, behind, np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes + 1)


def _sorted(*columns: np.ndarray) -> list[np.ndarray]:
    """Rows of unsigned numbers in order, the first column first."""
    bits = [int(c.max()).bit_length() if len(c) else 0 for c in columns]
    if sum(bits) > 64:
        order = np.lexsort(columns[::-1])
        return [c[order] for c in columns]
    key = columns[0].astype(np.uint64)
    for c, size in zip(columns[1:], bits[1:]):
        key = key << np.uint64(size) | c
    key.sort()
    found = []
    for size in bits[:0:-1]:
        found.append(key & np.uint64((1 << size) - 1))
        key = key >> np.uint64(size)
    return [key, *found[::-1]]


def _order(*columns: np.ndarray) -> np.ndarray:
    """The order of rows of unsigned numbers, fast where most are in order; equal rows stay as they are."""
    bits = [int(c.max()).bit_length() if len(c) else 0 for c in columns]
    if sum(bits) > 64:
        return np.lexsort(columns[::-1])
    key = columns[0].astype(np.uint64)
    for c, size in zip(columns[1:], bits[1:]):
        key = key << np.uint64(size) | c
    return np.argsort(key, kind="stable")


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where another row begins in sorted columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.r_[True, reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])])


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else values[:0]


def _pair_keys(before: np.ndarray, line: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of classes, which deal them to partitions."""
    return mixed(mixed(before) * np.uint64(0x9E3779B97F4A7C15) + line)


def _joint(before: np.ndarray, line: np.ndarray, wide: bool) -> np.ndarray:
    """Pairs of codes as one number; of a vocabulary that does not fit (``wide``) as their hash."""
    return _pair_keys(before, line) if wide else before << np.uint64(32) | line


def _triple_keys(place: np.ndarray, behind: np.ndarray) -> np.ndarray:
    """What follows pairs of one partition, given by their places, as one number."""
    return place.astype(np.uint64) << np.uint64(38) | behind


def _dealt(home_of, keys: list[np.ndarray], rest: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray, list[np.ndarray]]]:
    """By partition, of rows sorted by keys: distinct keys, how many rows each has, and the rest of these rows."""
    first = _starts(*keys)
    times = np.diff(np.r_[first, len(keys[0])])
    keys = [k[first] for k in keys]
    home = home_of(*keys)
    home = home.astype(np.uint16 if not len(home) or home.max() < 1 << 16 else np.uint32)
    own, each = np.argsort(home, kind="stable"), np.repeat(home, times)
    order = np.argsort(each, kind="stable")
    starts, homes = _by_part(own, home[own])
    cuts = np.searchsorted(each[order], homes[1:])
    keys, rest = ([np.split(c[o], at) for c in columns] for columns, o, at in (([*keys, times], own, starts[1:]), (rest, order, cuts)))
    for i, p in enumerate(homes.tolist()):
        *found, n = (k[i] for k in keys)
        yield p, found, n, [r[i] for r in rest]


# Pairs of classes with their counts and the count of the class behind (if it has no small code), and by
# pairs the number of classes that followed, these, and how often they did.
_COLUMNS = {"before": "<u8", "line": "<u8", "counts": "<u8", "times": "<u8", "n_behind": "<u4", "behind": "<u8", "behind_counts": "<u8"}
_PAIRS = "p int, " + ", ".join(f"{name} binary" for name in _COLUMNS)


def _pairs(p: int, found: list[np.ndarray]) -> dict:
    return {"p": p} | {name: _pack(values.astype(kind, copy=False)) for (name, kind), values in zip(_COLUMNS.items(), found)}


def count_pairs(coded: DataFrame, parts: int, length: int = 2) -> DataFrame:
    """Counts of all training pairs of classes, and (if ``length`` is 3) of what followed each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                alphabet, before, line, behind, _ = _tokens(row, ~np.array(row["held"], dtype=bool))
                none = np.searchsorted(alphabet, np.uint64(_START))
                if length == 2:
                    behind[:] = none
                seen = np.zeros(len(alphabet), "<u8")
                codes = _unpack(row["codes"], "<u8")
                seen[np.searchsorted(alphabet, codes)] = _unpack(row["counts"], "<u8")
                seen[alphabet < _IDS] = 0
                before, line, behind = _sorted(before, line, behind)
                first = _starts(before, line, behind)
                counts = np.diff(np.r_[first, len(line)])
                dealt = _dealt(lambda a, b: _part(_pair_keys(alphabet[a], alphabet[b]), parts), [before[first], line[first]], [behind[first], counts])
                del before, line, behind, first
                for p, (a, b), size, (after, n) in dealt:
                    starts, follows = np.cumsum(size) - size, after != none
                    found = [alphabet[a], alphabet[b], np.add.reduceat(n, starts), seen[b], np.add.reduceat(follows.astype("<u4"), starts)]
                    yield pa.RecordBatch.from_pylist([_pairs(p, [*found, alphabet[after[follows]], n[follows]])], _arrow(_PAIRS))

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        before, line, counts, times, size, behind, after = (np.concatenate([_unpack(r[name], kind) for r in rows]) for name, kind in _COLUMNS.items())
        order = _order(before, line)
        before, line = before[order], line[order]
        first = _starts(before, line)
        place = np.empty(len(order), np.uint32)
        place[order] = np.repeat(np.arange(len(first), dtype=np.uint32), np.diff(np.r_[first, len(order)]))
        pairs = [before[first], line[first], _sums(counts[order], first), times[order[first]]]
        place = np.repeat(place, size)
        order = _order(place, behind)
        place, behind = place[order], behind[order]
        starts = _starts(place, behind)
        pairs += [np.bincount(place[starts], minlength=len(first)), behind[starts], _sums(after[order], starts)]
        return pa.Table.from_pylist([_pairs(rows[0]["p"], pairs)], _arrow(_PAIRS))

    partial = coded.select("codes", "counts", "places", "sizes", "held").mapInArrow(run, _PAIRS)
    return _written(partial.groupBy("p").applyInArrow(merge, _PAIRS), "pairs")


def _class_shares(spark: SparkSession, model: Model):
    """What gives the shares of classes, from codes and the counts of those without a small code."""
    shared, few, total = spark.sparkContext.broadcast(model.shares()), model.share(np.arange(K + 2)), model.total

    def shares(codes: np.ndarray, times: np.ndarray) -> np.ndarray:
        own = np.where(times > K + 1, times / (total + 2.0), few[np.minimum(times, K + 1).astype(np.int64)])
        return np.where(codes < _IDS, shared.value[np.minimum(codes, _IDS - 1).astype(np.int64)], own)

    return shares


def _split(n_keys: int, *columns: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The rows in order, as keys and the rest."""
    found = _sorted(*columns)
    return found[:n_keys], found[n_keys:]


def _context_home(codes: np.ndarray, parts: int) -> np.ndarray:
    return _part(mixed(codes), parts)


def _factors(cut: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return cut[np.minimum(counts, K + 1).astype(np.int64)]


def _discounts(pairs: DataFrame, column: str) -> np.ndarray:
    """The discounts of all counts of a column."""
    names = [f"n{r}" for r in range(1, K + 2)]

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(column).to_pylist():
                counts = _unpack(packed, "<u8")
                yield pa.RecordBatch.from_arrays([pa.array([int((counts == r).sum())]) for r in range(1, K + 2)], names=names)

    found = pairs.select(column).mapInArrow(sizes, ", ".join(f"{n} long" for n in names)).agg(*[F.sum(n).alias(n) for n in names]).first()
    return discounts({r: found[f"n{r}"] or 0 for r in range(1, K + 2)})


def _back_off(mass: np.ndarray, freed: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logarithms of the back-off weights of contexts, what to divide their counts by, and which counts are not discounted."""
    left = 1 - mass
    full = left <= 1e-9  # every class follows: nothing is held back
    # Without singletons nothing is freed; a context then keeps a share as if seen once more.
    starved = ~full & (freed <= 0)
    n = n + starved
    alpha = np.where(full, 1.0, np.where(starved, 1.0, freed) / n / np.where(full, 1.0, left))
    return np.log10(alpha), n, full | starved


def normalise(pairs: DataFrame, shares_of, parts: int) -> tuple[DataFrame, np.ndarray]:
    """Logarithms of the back-off weight of each context (level 1), what the partitions of pairs need
    of their contexts (level 2), and the discounts."""
    asked_schema = "p int, q int, keys binary, mass binary, freed binary, n binary"
    context_schema = "p int, level int, home int, keys binary, values binary, n binary, plain binary"
    cut = _discounts(pairs, "counts")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = _unpack(row["counts"], "<u8").astype(np.float64)
                keys, place = np.unique(_unpack(row["before"], "<u8"), return_inverse=True)
                shares = shares_of(_unpack(row["line"], "<u8"), _unpack(row["times"], "<u8"))
                sums = [np.bincount(place, weights=w) for w in (shares, (1 - _factors(cut, counts)) * counts, counts)]
                home = _context_home(keys, parts)
                order = np.argsort(home, kind="stable")
                starts, homes = _by_part(order, home[order])
                for p, *own in zip(homes.tolist(), *[np.split(c[order], starts[1:]) for c in (keys, *sums)]):
                    found = dict(zip(_arrow(asked_schema).names, [p, row["p"], *map(_pack, own)]))
                    yield pa.RecordBatch.from_pylist([found], _arrow(asked_schema))

    def weigh(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["q"])
        asked = [_unpack(r["keys"], "<u8") for r in rows]
        keys, place = np.unique(np.concatenate(asked), return_inverse=True)
        sums = (np.bincount(place, weights=np.concatenate([_unpack(r[name], "<f8") for r in rows])) for name in ("mass", "freed", "n"))
        logs, n, plain = _back_off(*sums)
        n, plain = n.astype("<u8"), plain.astype("u1")
        out = [{"p": rows[0]["p"], "level": 1, "keys": _pack(keys), "values": _pack(logs)}]
        for row, own in zip(rows, np.split(place, np.cumsum([len(a) for a in asked])[:-1])):
            out.append({
                "p": row["q"], "level": 2, "home": row["p"], "values": _pack(logs[own]), "n": _pack(n[own]), "plain": _pack(plain[own]),
            })
        return pa.Table.from_pylist(out, _arrow(context_schema))

    asked = pairs.mapInArrow(ask, asked_schema)
    return _written(asked.groupBy("p").applyInArrow(weigh, context_schema), "contexts"), cut


def _known(row: dict, replies: list[dict], cut: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms of P(b | a) of each pair of a partition, and of the back-off weight of its context."""
    # Replies hold what was asked for in the same order: by home, then code.
    found = sorted(replies, key=lambda r: r["home"])
    before = _unpack(row["before"], "<u8")
    first = _starts(before)
    order = np.argsort(_context_home(before[first], parts), kind="stable")
    columns = []
    for name, kind in (("values", "<f8"), ("n", "<u8"), ("plain", "u1")):
        values = np.empty(len(first), kind)
        values[order] = np.concatenate([_unpack(r[name], kind) for r in found])
        columns.append(np.repeat(values, np.diff(np.r_[first, len(before)])))
    logs, n, plain = columns
    counts = _unpack(row["counts"], "<u8").astype(np.float64)
    return np.log10(np.where(plain > 0, 1.0, _factors(cut, counts)) * counts) - np.log10(n), logs


def _triples(row: dict, parts: int) -> tuple[np.ndarray, ...]:
    """Of each triple of a partition of pairs the place of its first pair and of its last pair among the different
    last pairs, these, the order in which they are asked for, and their partitions in that order."""
    size = _unpack(row["n_behind"], "<u4")
    place = np.repeat(np.arange(len(size)), size)
    line, behind = _unpack(row["line"], "<u8")[place], _unpack(row["behind"], "<u8")
    order = _order(line, behind)
    line, behind = line[order], behind[order]
    first = _starts(line, behind)
    last = np.empty(len(order), np.int64)
    last[order] = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(order)]))
    line, behind = line[first], behind[first]
    home = _part(_pair_keys(line, behind), parts)
    order = np.argsort(home.astype(np.uint16 if parts <= 1 << 16 else np.uint32), kind="stable")
    return place, last, line[order], behind[order], order, home[order]


_SHARES = "p int, level int, home int, values binary"


def last_pairs(pairs: DataFrame, tables: DataFrame, cut: np.ndarray, parts: int, wide: bool, low: int, high: int) -> DataFrame:
    """What partitions ``low`` to ``high - 1`` need of their triples' last pairs: logarithms of P(c | b) (level 4)."""
    asked_schema = "p int, q int, keys binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, line, behind, _, home = _triples(row, parts)
                starts, homes = _by_part(line, home)
                for p, own in zip(homes.tolist(), np.split(_joint(line, behind, wide), starts[1:])):
                    yield pa.RecordBatch.from_pylist([{"p": p, "q": row["p"], "keys": _pack(own)}], _arrow(asked_schema))

    def answer(asked: pa.Table, table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        out = []
        if asked.num_rows:
            row = next(r for r in rows if r["level"] == 3)
            logs, _ = _known(row, [r for r in rows if r["level"] == 2], cut, parts)
            lookup = _Lookup.of(_joint(_unpack(row["before"], "<u8"), _unpack(row["line"], "<u8"), wide), logs)
            for r in asked.to_pylist():
                out.append({"p": r["q"], "level": 4, "home": r["p"], "values": _pack(lookup.values_of(_unpack(r["keys"], "<u8")))})
        return pa.Table.from_pylist(out, _arrow(_SHARES))

    asked = pairs.where((F.col("p") >= low) & (F.col("p") < high)).select("p", "line", "n_behind", "behind").mapInArrow(ask, asked_schema)
    own = tables.where("level in (2, 3)").drop("times", "n_behind", "behind", "behind_counts", "keys")
    return asked.groupBy("p").cogroup(own.groupBy("p")).applyInArrow(answer, _SHARES)


def _followed(row: dict, replies: list[dict], cut: np.ndarray, parts: int) -> tuple[np.ndarray, _Lookup]:
    """Logarithms of the back-off weights of all pairs of a partition as contexts, and what its triples add."""
    n_pairs = len(_unpack(row["n_behind"], "<u4"))
    if not row["behind"]:
        return np.zeros(n_pairs), _Lookup()
    place, last, _, _, order, _ = _triples(row, parts)
    lower = np.empty(len(order))
    lower[order] = np.concatenate([_unpack(r["values"], "<f8") for r in sorted(replies, key=lambda r: r["home"])])
    lower = lower[last]
    counts = _unpack(row["behind_counts"], "<u8").astype(np.float64)
    mass, freed, n = (np.bincount(place, weights=w, minlength=n_pairs) for w in (10**lower, (1 - _factors(cut, counts)) * counts, counts))
    logs, n, plain = _back_off(mass, freed, n)
    added = np.log10(np.where(plain[place], 1.0, _factors(cut, counts)) * counts) - np.log10(n[place]) - logs[place] - lower
    return np.where(np.bincount(place, minlength=n_pairs) > 0, logs, 0.0), _Lookup(_triple_keys(place + 1, _unpack(row["behind"], "<u8")), added)


def frequent_weights(contexts: DataFrame) -> np.ndarray:
    """Back-off weights of the contexts with small codes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, values = _unpack(row["keys"], "<u8"), _unpack(row["values"], "<f8")
                chosen = keys < _IDS
                yield pa.RecordBatch.from_arrays([pa.array(keys[chosen].astype(np.int64)), pa.array(values[chosen])], names=["key", "value"])

    found = contexts.mapInArrow(run, "key long, value double").toPandas()
    values = np.zeros(_IDS)  # a context that never occurred leaves everything to the shares
    values[found["key"].to_numpy().astype(np.int64)] = found["value"].to_numpy()
    return values


_REQUEST = (
    "p int, block long, n_docs int, contexts binary, context_times binary, context_docs binary, before binary, line binary, pair_times binary, "
    "pair_docs binary, behind binary, ids array<long>, held array<boolean>, sizes binary, known binary, base binary, score binary"
)
_PARTIAL = "p int, block long, docs binary, known binary, base binary, score binary, ids array<long>, held array<boolean>, sizes binary"


def score(
    coded: DataFrame, model: Model, shares_of, weighed: DataFrame, cut: np.ndarray, pairs: DataFrame, parts: int, length: int = 2
) -> DataFrame:
    """Scores of all documents of coded blocks."""
    weights = frequent_weights(weighed.where("level = 1").select("keys", "values"))
    shared = coded.sparkSession.sparkContext.broadcast(weights)
    cuts = [cut, _discounts(pairs, "behind_counts")] if length == 3 else [cut]
    tables = weighed.unionByName(pairs.withColumn("level", F.lit(3)), allowMissingColumns=True)
    step, sums, wide = -(-parts // PASSES), [], model.distinct >= 1 << 31
    for low in range(0, parts, step):
        high = min(low + step, parts)
        own, read = tables, [coded, weighed, pairs] if high == parts else []
        if length == 3:
            last = _written(last_pairs(pairs, tables, cut, parts, wide, low, high), "last")
            own, read = tables.unionByName(last, allowMissingColumns=True), [last, *read]
        sums.append(_written(_asked(coded, shared, own, shares_of, cuts, parts, wide, low, high), "sums", *read))

    def columns(table: pa.Table) -> pa.Table:
        row = _summed(table.to_pylist())
        return pa.table({
            "id": pa.array(row["ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": _unpack(row["sizes"], "<i8"),
            "n_known": _unpack(row["known"], "<i8"), "base_score": _unpack(row["base"], "<f8"), "score": _unpack(row["score"], "<f8"),
        })

    scored = reduce(DataFrame.union, sums).groupBy("block").applyInArrow(
        columns, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return scored.withColumn("train_tokens", F.lit(model.total).cast("long"))


def _asked(
    coded: DataFrame, shared, tables: DataFrame, shares_of, cuts: list[np.ndarray], parts: int, wide: bool, low: int, high: int
) -> DataFrame:
    """Sums per block of what partitions ``low`` to ``high - 1`` answer; with the first of all come what the blocks know themselves."""

    with_triples = len(cuts) > 1

    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                alphabet, before, line, behind, docs = _tokens(row)
                block, n_docs = row["block"], len(row["ids"])
                rows: dict[int, dict] = {}
                small = (alphabet < _IDS)[before]
                if not low:
                    values = shared.value[np.minimum(alphabet, _IDS - 1).astype(np.int64)]
                    own = np.bincount(docs[small], weights=values[before[small]], minlength=n_docs)
                    rows[block % high] = {
                        **{name: row[name] for name in ("ids", "held", "known", "base")}, "score": _pack(_unpack(row["score"], "<f8") + own),
                        "sizes": _pack((_unpack(row["sizes"], "<u4").astype(np.int64) + 1).astype("<i8")),
                    }
                homes = _context_home(alphabet, parts).astype("<u4")
                at = np.flatnonzero(~small & (homes[before] >= low) & (homes[before] < high))
                for p, (keys,), times, (where,) in _dealt(lambda a: homes[a], *_split(1, before[at], docs[at])):
                    found = {"contexts": alphabet[keys], "context_times": times.astype("<u4"), "context_docs": where.astype("<u4")}
                    rows.setdefault(p, {}).update({name: _pack(values) for name, values in found.items()})
                del small, homes, at
                # Partitions by stretches, so that only a few are sorted at a time.
                stretches = [slice(i, i + STRETCH_TOKENS) for i in range(0, len(line), STRETCH_TOKENS)]
                home = np.concatenate([_part(_pair_keys(alphabet[before[c]], alphabet[line[c]]), parts).astype("<u4") for c in stretches])
                step, home_of = max(1, parts * STRETCH_TOKENS // len(home)), lambda a, b: _part(_pair_keys(alphabet[a], alphabet[b]), parts)
                for first in range(low, high, step):
                    at = np.flatnonzero((home >= first) & (home < min(first + step, high)))
                    dealt = _dealt(home_of, *_split(2, before[at], line[at], behind[at], docs[at]))
                    for p, keys, times, (after, where) in dealt:
                        found = {"before": alphabet[keys[0]], "line": alphabet[keys[1]], "pair_times": times.astype("<u4"), "pair_docs": where.astype("<u4")}
                        if with_triples:
                            found["behind"] = alphabet[after]
                        rows.setdefault(p, {}).update({name: _pack(values) for name, values in found.items()})
                del before, line, behind, docs, home
                for p, found in rows.items():
                    yield pa.RecordBatch.from_pylist([{"p": p, "block": block, "n_docs": n_docs, **found}], _arrow(_REQUEST))

    def answer(asked: pa.Table, tables: pa.Table) -> pa.Table:
        by_level: dict[int, list[dict]] = {1: [], 2: [], 3: [], 4: []}
        for row in tables.to_pylist():
            by_level[row["level"]].append(row)
        contexts, pairs, triples = _Lookup(), _Lookup(), _Lookup()
        added = follow = np.zeros(1)
        for row in by_level[1]:
            contexts = _Lookup(_unpack(row["keys"], "<u8"), _unpack(row["values"], "<f8"))
        for row in by_level[3]:
            line = _unpack(row["line"], "<u8")
            logs, back = _known(row, by_level[2], cuts[0], parts)
            pairs = _Lookup.of(_joint(_unpack(row["before"], "<u8"), line, wide), np.arange(1, len(line) + 1))
            added = np.r_[0.0, logs - back - np.log10(shares_of(line, _unpack(row["times"], "<u8")))]
            follow, triples = _followed(row, by_level[4], cuts[-1], parts)
            follow = np.r_[0.0, follow]
        out = []
        for batch in asked.to_batches(max_chunksize=16):
            for row in batch.to_pylist():
                n = row["n_docs"]
                known, base, total = np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
                if row["contexts"]:
                    logs = np.repeat(contexts.values_of(_unpack(row["contexts"], "<u8")), _unpack(row["context_times"], "<u4"))
                    total += np.bincount(_unpack(row["context_docs"], "<u4"), weights=logs, minlength=n)
                if row["before"]:
                    keys = _joint(_unpack(row["before"], "<u8"), _unpack(row["line"], "<u8"), wide)
                    docs, times = _unpack(row["pair_docs"], "<u4"), _unpack(row["pair_times"], "<u4")
                    place = pairs.values_of(keys).astype(np.int64)
                    total += np.bincount(docs, weights=np.repeat(added[place], times), minlength=n)
                    if row["behind"]:
                        behind, place = _unpack(row["behind"], "<u8"), np.repeat(place, times)
                        at = np.flatnonzero((place > 0) & (behind != _START))
                        logs = follow[place[at]] + triples.values_of(_triple_keys(place[at], behind[at]))
                        total += np.bincount(docs[at], weights=logs, minlength=n)
                if row["ids"] is not None:
                    known += _unpack(row["known"], "<i8")
                    base += _unpack(row["base"], "<f8")
                    total += _unpack(row["score"], "<f8")
                    touched = np.arange(n)
                else:
                    touched = np.flatnonzero(total != 0)
                out.append({
                    "p": row["p"], "block": row["block"], "docs": _pack(touched.astype("<u4")), "known": _pack(known[touched].astype("<i8")),
                    "base": _pack(base[touched]), "score": _pack(total[touched]), "ids": row["ids"], "held": row["held"], "sizes": row["sizes"],
                })
        return pa.Table.from_pylist(out, _arrow(_PARTIAL))

    def gather(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist([_summed(table.to_pylist())], _arrow(_PARTIAL))

    asked = coded.mapInArrow(requests, _REQUEST)
    own = tables.where((F.col("p") >= low) & (F.col("p") < high))
    partial = asked.groupBy("p").cogroup(own.groupBy("p")).applyInArrow(answer, _PARTIAL)
    return partial.groupBy("block").applyInArrow(gather, _PARTIAL)


def _summed(rows: list[dict]) -> dict:
    """Partial sums of one block as one, added in the order of their partitions."""
    rows.sort(key=lambda r: r["p"])
    docs = [_unpack(r["docs"], "<u4") for r in rows]
    n = max((int(d[-1]) + 1 for d in docs if len(d)), default=0)
    out = dict(rows[0], docs=_pack(np.arange(n, dtype="<u4")))
    for name, kind in (("known", "<i8"), ("base", "<f8"), ("score", "<f8")):
        sums = np.zeros(n, kind)
        for at, row in zip(docs, rows):
            sums[at] += _unpack(row[name], kind)
        out[name] = _pack(sums)
    main = next((r for r in rows if r["ids"] is not None), rows[0])
    return out | {name: main[name] for name in ("ids", "held", "sizes")}


class _Lookup:
    """Values by sorted keys; 0 for other keys."""

    def __init__(self, keys: np.ndarray = np.zeros(0, "<u8"), values: np.ndarray = np.zeros(0)):
        self.keys, self.values = keys, values

    @staticmethod
    def of(keys: np.ndarray, values: np.ndarray) -> _Lookup:
        if (keys[1:] < keys[:-1]).any():
            order = np.argsort(keys)
            keys, values = keys[order], values[order]
        return _Lookup(keys, values)

    def values_of(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=self.values.dtype)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], 0)


def _arrow(schema: str) -> pa.Schema:
    kinds = {
        "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
        "array<boolean>": pa.list_(pa.bool_()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in schema.split(", "))])


def train_and_score(
    documents: DataFrame, held_out: Column, order: str = "doc_id", text: str = "text", length: int = 2, pooled: bool = True
) -> DataFrame:
    """Learn from the documents that are not held out, score all."""
    spark = documents.sparkSession
    parts = 2 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    chosen = documents.select(F.col(order).cast("long").alias("id"), held_out.alias("held"), F.col(text).alias("text"))
    # Of a table that is written, the files it was shuffled through are not needed any more.
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        words = count_words(chosen, parts)
        model = vocabulary(words)
        coded = code_words(write_blocks(chosen), words, model, parts, pooled)
        # A partition of pairs must fit a task's memory however large the corpus is.
        parts, shares_of = max(parts, -(-model.total // PART_TOKENS)), _class_shares(spark, model)
        pairs = count_pairs(coded, parts, length)
        weighed, cut = normalise(pairs, shares_of, parts)
        return score(coded, model, shares_of, weighed, cut, pairs, parts, length)
