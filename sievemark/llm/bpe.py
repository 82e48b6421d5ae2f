"""Byte-level BPE encoding through a transducer lexicon, and decoding.

The most frequent words of the corpus, counted over all documents, are compiled with
their ids into a minimal acyclic transducer (``lexicon``). Its file goes to the shared
folder, every executor fetches it and maps it into memory. A task looks up the
distinct words of its documents there; words the lexicon lacks are merged exactly, all
of them together, by rounds of numpy operations over their symbols.

A word here is a piece of text between single spaces, with the space before it. A
text with a space next to other white space, or at an end, is cut by the tokenizer's
own pattern instead. Both give what the tokenizers library gives.

Defined cases: null and empty texts have no ids; a special token in a text is its id;
an empty table gives an empty result; repeated rows and extra columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievemark import session
from sievemark.llm.columns import without
from sievemark.llm.lexicon import Lexicon, compile_words, find, hash_table
from sievemark.llm.scratch import scratch_path

LEXICON_WORDS = 32_768
CACHED_WORDS = 150_000
CHUNK_CHARS = 1 << 20

# Fixed value: the pre-tokenizer pattern of byte-level BPE.
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_RARE_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in the vocabulary: printable ones for themselves,
    the others in turn from code point 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Tables:
    """Vocabulary and merges of a byte-level BPE tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        vocabulary = spec["model"]["vocab"]
        letters = byte_letters()
        byte_of = {c: b for b, c in letters.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.first = np.array([vocabulary[letters[b]] for b in range(256)], dtype=np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left = np.array([vocabulary[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocabulary[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        self.ranks = hash_table(left << 32 | right)
        size = max([*vocabulary.values(), *self.special.values()]) + 1
        spelling = [b""] * size
        for token, i in vocabulary.items():
            spelling[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        for token, i in self.special.items():
            spelling[i] = token.encode()
        self.lengths = np.array([len(s) for s in spelling], dtype=np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelling), dtype=np.uint8)

    def merge(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact ids of words (pre-tokens, their bytes one after the other), and how many each has.

        In every round each word merges its pair of lowest rank wherever it stands,
        until no word has a pair left.
        """
        symbols = self.first[data]
        active = np.flatnonzero(sizes)
        counts = np.zeros(len(sizes), dtype=np.int64)
        sizes = sizes[active]
        never = np.int64(1) << 40
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        while len(active):
            starts = np.cumsum(sizes) - sizes
            rank = np.full(len(symbols), never)
            inside = np.ones(len(symbols), dtype=bool)
            inside[starts + sizes - 1] = False
            at = np.flatnonzero(inside)
            found = find(symbols[at] << 32 | symbols[at + 1], *self.ranks)
            rank[at] = np.where(found >= 0, found, never)
            lowest = np.minimum.reduceat(rank, starts)
            done = lowest == never
            if done.any():
                stay = np.repeat(~done, sizes)
                counts[active[done]] = sizes[done]
                finished.append((np.repeat(active[done], sizes[done]), symbols[~stay]))
                symbols, rank = symbols[stay], rank[stay]
                active, sizes, lowest = active[~done], sizes[~done], lowest[~done]
                if not len(active):
                    break
            owner = np.repeat(np.arange(len(active)), sizes)
            chosen = np.flatnonzero(rank == lowest[owner])
            # Occurrences overlap only in runs of one symbol: there every other one merges.
            fresh = np.flatnonzero(np.r_[True, np.diff(chosen) != 1])
            turn = np.arange(len(chosen)) - np.repeat(fresh, np.diff(np.r_[fresh, len(chosen)]))
            twins = symbols[chosen] == symbols[chosen + 1]
            chosen = chosen[~twins | (turn % 2 == 0)]
            symbols[chosen] = self.made[rank[chosen]]
            keep = np.ones(len(symbols), dtype=bool)
            keep[chosen + 1] = False
            sizes = sizes - np.bincount(owner[chosen], minlength=len(active))
            symbols = symbols[keep]
        if not finished:
            return np.zeros(0, dtype=np.int64), counts
        owners = np.concatenate([o for o, _ in finished])
        return np.concatenate([x for _, x in finished])[np.argsort(owners, kind="stable")], counts

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that ids stand for."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.offsets[ids] - (ends - lengths), lengths)
        return self.bytes[shift + np.arange(len(shift))]


@lru_cache(maxsize=2)
def _tables(content: str) -> Tables:
    return Tables(content)


def _loose_space(text: str) -> bool:
    """Is a space next to other white space or at an end? (Any rarer white space counts too.)"""
    return (
        "  " in text
        or " \n" in text
        or "\n " in text
        or text[:1] == " "
        or text[-1:] == " "
        or _RARE_SPACE.search(text) is not None
    )


def _slice_ids(known: dict[str, bytes], pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
    flat = ids.astype("<u4").tobytes()
    ends = (np.cumsum(sizes) * 4).tolist()
    for piece, begin, end in zip(pieces, [0, *ends], ends):
        known[piece] = flat[begin:end]


class Encoder:
    """Encodes texts; keeps words it has met, up to a bound."""

    def __init__(self, tables: Tables, lexicon: Lexicon | None):
        self.tables, self.lexicon = tables, lexicon
        self.inner: dict[str, bytes] = {}  # words with a space before them, by the word alone
        self.outer: dict[str, bytes] = {}  # pieces as they stand

    def forget(self) -> None:
        """Give the words back at the end of a task; the worker may serve other stages next."""
        self.inner.clear()
        self.outer.clear()

    def _resolve(self, pieces: list[str], spaced: bool) -> dict[str, bytes]:
        """Ids of distinct pieces: from the lexicon, else by exact merging."""
        lead = " " if spaced else ""
        raw = [(lead + p).encode("utf-8", "surrogatepass") for p in pieces]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        ranks = np.full(len(raw), -1) if self.lexicon is None else self.lexicon.ranks(data, np.cumsum(sizes) - sizes, sizes)
        known: dict[str, bytes] = {}
        hits = np.flatnonzero(ranks >= 0).tolist()
        if hits:
            _slice_ids(known, [pieces[i] for i in hits], *self.lexicon.outputs(ranks[hits]))
        unseen = np.flatnonzero(ranks < 0).tolist()
        parts: list[bytes] = []
        owned: list[int] = []
        for i in unseen:
            if spaced and pieces[i].isalpha():
                parts.append(raw[i])
                owned.append(1)
            else:
                own = _PATTERN.findall(lead + pieces[i])
                parts.extend([m.encode("utf-8", "surrogatepass") for m in own])
                owned.append(len(own))
        if unseen:
            ids, counts = self.tables.merge(
                np.frombuffer(b"".join(parts), dtype=np.uint8), np.fromiter(map(len, parts), np.int64, len(parts))
            )
            ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(owned)])]
            _slice_ids(known, [pieces[i] for i in unseen], ids, np.diff(ends))
        return known

    def _ids_of(self, pieces: set[str], cache: dict[str, bytes], spaced: bool) -> dict[str, bytes]:
        """The cache, or for this call a copy-free view that also holds what did not fit."""
        missing = list(pieces.difference(cache))
        if not missing:
            return cache
        found = self._resolve(missing, spaced)
        if len(cache) + len(found) <= CACHED_WORDS:
            cache.update(found)
            return cache
        for piece in pieces:
            if piece in cache:
                found[piece] = cache[piece]
        return found

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        plans: list[list[tuple[str, list[str]]]] = []
        inner: set[str] = set()
        outer: set[str] = set()
        special = self.tables.special
        for text in texts:
            whole = not any(s in text for s in special)
            plan: list[tuple[str, list[str]]] = []
            for segment in [text] if whole else self.tables.splitter.split(text):
                if segment in special:
                    plan.append(("special", [segment]))
                elif _loose_space(segment):
                    pieces = _PATTERN.findall(segment)
                    outer.update(pieces)
                    plan.append(("outer", pieces))
                elif segment:
                    pieces = segment.split(" ")
                    outer.add(pieces[0])
                    inner.update(pieces[1:])
                    plan.append(("words", pieces))
            plans.append(plan)
        in_ids, out_ids = self._ids_of(inner, self.inner, True), self._ids_of(outer, self.outer, False)
        encoded = []
        for plan in plans:
            ids: list[bytes] = []
            for kind, pieces in plan:
                if kind == "words":
                    ids.append(out_ids[pieces[0]])
                    del pieces[0]
                    ids.extend(map(in_ids.__getitem__, pieces))
                elif kind == "outer":
                    ids.extend(map(out_ids.__getitem__, pieces))
                else:
                    ids.append(special[pieces[0]].to_bytes(4, "little"))
            encoded.append(b"".join(ids))
        return encoded


def word_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """How often each word (with its space, at most 64 characters) occurs in all documents.

    Tasks count first; only their distinct words move. Longer words still encode
    exactly, they are just never worth a lexicon entry.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[str] = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for value in batch.column(0).slice(at, 256).to_pylist():
                    if value:
                        counter.update(value.split(" ")[1:])
                if len(counter) > 400_000:
                    yield _counted(counter)
                    counter = Counter()
        yield _counted(counter)

    partial = documents.select(text).mapInArrow(count, "word string, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def _counted(counter: Counter[str]) -> pa.RecordBatch:
    words = [w for w in counter if w and len(w) <= 64 and not any(map(str.isspace, w))]
    return pa.RecordBatch.from_arrays(
        [pa.array(words, pa.string()), pa.array([counter[w] for w in words], pa.int64())], names=["word", "n"]
    )


def frequent_words(counts: DataFrame, size: int) -> list[str]:
    """At most ``size`` of the most frequent words: all from the smallest count class that leaves no more.

    The classes (16 to an octave) are counted first, so that no more than ``size`` words
    leave the executors, however many tasks hold them.
    """
    spark = counts.sparkSession
    path = scratch_path(spark, "words")
    counts.write.parquet(path)
    counted = spark.read.parquet(path).withColumn("__class", F.floor(F.log2("n") * 16 + 1e-9))
    classes = sorted(counted.groupBy("__class").agg(F.count("*").alias("words")).collect(), reverse=True)
    taken, least = 0, None
    for row in classes:
        if taken + row["words"] > size:
            break
        taken, least = taken + row["words"], row["__class"]
    if least is None:
        return []
    rows = counted.where(F.col("__class") >= least).select("word", "n").collect()
    return [r["word"] for r in sorted(rows, key=lambda r: (-r["n"], r["word"]))]


def publish_lexicon(
    documents: DataFrame, tokenizer: str, text: str = "text", size: int = LEXICON_WORDS
) -> str:
    """Compile the most frequent words (at most ``size``) and send the file to all executors; its name."""
    spark = documents.sparkSession
    tables = _tables(_content(tokenizer))
    words = [" " + w for w in frequent_words(word_counts(documents, text), size)]
    words = [w for w in words if not any(s in w for s in tables.special)]
    plain = Encoder(tables, None)
    found = plain._resolve([w[1:] for w in words], True)
    blob = compile_words([w.encode() for w in words], [found[w[1:]] for w in words])
    return _send(spark, blob)


def _send(spark: SparkSession, blob: bytes) -> str:
    """Write a file to the shared folder and add it to the files of this application.

    Executors that join later fetch it too.
    """
    # Not one of a step's own tables: executors that join later still ask for it.
    path = session.scratch_path(spark, "lexicon") + ".bin"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target)
    stream.write(bytearray(blob))
    stream.close()
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[1]


def _content(tokenizer: str) -> str:
    with open(tokenizer, encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=1)
def _encoder(tokenizer: str, lexicon: str) -> Encoder:
    return Encoder(_tables(_content(tokenizer)), Lexicon(SparkFiles.get(lexicon)))


def _chunks(values: list[str]) -> Iterator[list[str]]:
    chunk: list[str] = []
    size = 0
    for value in values:
        if chunk and size + len(value) > CHUNK_CHARS:
            yield chunk
            chunk, size = [], 0
        chunk.append(value)
        size += len(value)
    if chunk:
        yield chunk


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Stretches of rows of a bounded size together, with their texts (null: empty)."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            begin = 0
            for chunk in _chunks([v or "" for v in part.column(text).to_pylist()]):
                yield part.slice(begin, len(chunk)), chunk
                begin += len(chunk)


def encode(documents: DataFrame, tokenizer: str, text: str = "text", lexicon: str | None = None) -> DataFrame:
    """Add ``ids`` (little-endian unsigned 32-bit integers) to documents.

    ``tokenizer`` is the path of the tokenizer file, present on every node.
    """
    name = lexicon or publish_lexicon(documents, tokenizer, text)
    documents = without(documents, "ids")
    schema = T.StructType([*documents.schema.fields, T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, name)
        for part, texts in _slices(batches, text):
            ids = pa.array(encoder.encode(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, ids], names=schema.fieldNames())
        encoder.forget()

    return documents.mapInArrow(run, schema)


def round_trip(
    documents: DataFrame, tokenizer: str, text: str = "text", lexicon: str | None = None, keep_ids: bool = True
) -> DataFrame:
    """Replace the text by its id count, ``ids`` and digests of the ids and of the text decoded from them.

    Encoding and decoding share one pass and one Python worker.
    """
    name = lexicon or publish_lexicon(documents, tokenizer, text)
    documents = without(documents, "n_tokens", "ids", "ids_sha256", "decoded_sha256")
    kept = [f for f in documents.schema.fields if f.name != text]
    added = [
        T.StructField("n_tokens", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if keep_ids else []),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    schema = T.StructType([*kept, *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, name)
        for part, texts in _slices(batches, text):
            rows = encoder.encode(texts)
            columns = [part.column(f.name) for f in kept]
            columns.append(pa.array([len(r) // 4 for r in rows], pa.int64()))
            if keep_ids:
                columns.append(pa.array(rows, pa.binary()))
            columns.append(pa.array([hashlib.sha256(r).hexdigest() for r in rows], pa.string()))
            decoded = decode_rows(encoder.tables, rows)
            columns.append(pa.array([hashlib.sha256(t.encode()).hexdigest() for t in decoded], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
        encoder.forget()

    return documents.mapInArrow(run, schema)


def digests(documents: DataFrame, tokenizer: str, order: str = "doc_id", text: str = "text", lexicon: str | None = None) -> DataFrame:
    """Per document: id count, digest of the ids, and digest of the text decoded from them."""
    return round_trip(documents.select(order, text), tokenizer, text, lexicon, keep_ids=False)


def decode_rows(tables: Tables, rows: Sequence[bytes]) -> list[str]:
    """Texts of id rows; bytes that are no UTF-8 become replacement characters."""
    ids = np.frombuffer(b"".join(rows), dtype="<u4").astype(np.int64)
    sizes = np.array([len(r) // 4 for r in rows], dtype=np.int64)
    flat = tables.decode(ids).tobytes()
    ends = np.concatenate([[0], np.cumsum(tables.lengths[ids])])[np.concatenate([[0], np.cumsum(sizes)])]
    return [flat[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def decode(encoded: DataFrame, tokenizer: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the ``ids`` column; null ids give an empty text."""
    encoded = without(encoded, "decoded")
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables(_content(tokenizer))
        for batch in batches:
            rows = [r or b"" for r in batch.column(ids).to_pylist()]
            texts: list[str] = []
            for at in range(0, len(rows), 256):
                texts += decode_rows(tables, rows[at : at + 256])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.fieldNames())

    return encoded.mapInArrow(run, schema)
