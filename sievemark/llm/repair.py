"""Token ids in Re-Pair compressed blocks.

Documents are range-sorted by id; every task encodes its documents, appends an end id
to each, and compresses blocks of ids: again and again the most frequent pairs of
neighbouring symbols are replaced by new symbols, never across documents. A block
stores its rules, the length each rule expands to, the remaining symbols, and where
each document begins among them, so one document (or one position) is decoded without
the rest. Blocks are rows of a Parquet table in the order of the documents.

Format of a block row: ``shard, block`` (place in the order), ``tokens_before`` (ids of
the shard before it), ``n_tokens``, ``doc_ids``, ``symbol_ends`` and ``token_ends`` (per
document, exclusive), ``base`` (symbols from here on are rules), ``rules`` (left and right
symbol of each, unsigned 32-bit little-endian), ``rule_lengths`` (unsigned 32-bit) and
``symbols`` (unsigned 16-bit, or 32-bit where ``wide``).

Defined cases: null and empty texts hold the end id only; rows without an id come
first; repeated ids stay together, ordered by text; an empty table writes an empty
table; other columns are not stored.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.llm.bpe import byte_letters
from sievemark.llm.texts import chunk_ranges, text_buffers

BLOCK_TOKENS = 1 << 19
ROUNDS = 4
PAIRS_PER_ROUND = 1024
MIN_COUNT = 64
CACHED_WORDS = 400_000
CHUNK_BYTES = 1 << 22
_COUNT_BITS = 18
# Characters that stay single characters in lower case and normal form; no added token is spelled without "<".
_PLAIN = re.compile("[!-;=-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
# The tokenizer's pre-tokens, for these characters in lower case.
_LOW = "a-z\u00df-\u00f6\u00f8-\u00ff"
_PRE_TOKENS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LOW}]+|[0-9]|[^{_LOW}0-9]+")

_BLOCK = (
    "shard int, block int, tokens_before long, n_tokens long, doc_ids array<long>, symbol_ends array<int>, "
    "token_ends array<int>, base int, wide boolean, rules binary, rule_lengths binary, symbols binary"
)


_BYTE_LETTERS = byte_letters()


class _Known(dict):
    """Ids of words, asked for where not known. Of words not met for long none are kept:
    when full, the table becomes the older one, and a new one begins."""

    def __init__(self, ask):
        super().__init__({"": b""})
        self.ask, self.older = ask, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.ask(word)
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
            self[""] = b""
        self[word] = ids
        return ids


class Words:
    """Ids of texts by the tokenizers library, asked once per distinct word.

    Pieces between spaces and line ends are encoded by themselves, which gives the ids
    of the whole text: this tokenizer drops white space and lets nothing reach across it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size()
        self.model = self.tokenizer.model
        self.known = _Known(self._ask)

    def _ask(self, word: str) -> bytes:
        """Ids of a word. A plain word needs no normaliser but lower case; its pre-tokens'
        ids follow each other, and the model itself encodes a pre-token."""
        letters = word.isascii() and word.isalpha()  # one pre-token
        if not letters and _PLAIN.fullmatch(word) is None:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        low = word.lower()
        parts = [low] if letters else _PRE_TOKENS.findall(low)
        if len(parts) > 1 or low != word:
            return b"".join([self.known[p] for p in parts])
        spelled = low if low.isascii() else "".join([_BYTE_LETTERS[b] for b in low.encode()])
        return array("I", [t.id for t in self.model.tokenize(spelled)]).tobytes()

    def encode(self, texts: Sequence[str | None] | pa.Array) -> list[bytes]:
        """Native 32-bit ids of each text (null: none)."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        pieces = pc.split_pattern(pc.replace_substring(pc.fill_null(column, ""), "\n", " "), " ")
        words = pieces.flatten().dictionary_encode()
        found = [self.known[w] for w in words.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.array([len(f) // 4 for f in found], dtype=np.int64)
        at = words.indices.to_numpy()
        own = sizes[at]
        ends = np.concatenate([[0], np.cumsum(own)])
        shift = (np.cumsum(sizes) - sizes)[at] - ends[:-1]
        ids = np.frombuffer(b"".join(found), dtype=np.uint32)[np.repeat(shift, own) + np.arange(ends[-1])].tobytes()
        bounds = (4 * ends[pieces.offsets.to_numpy()]).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=2)
def _words(path: str) -> Words:
    return Words(path)


def compress(
    tokens: np.ndarray, ends: np.ndarray, base: int, rounds: int = ROUNDS, per_round: int = PAIRS_PER_ROUND, min_count: int = MIN_COUNT
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, symbol ends of the documents, rules (n x 2) and the lengths they expand to.

    ``ends`` are the documents' exclusive ends in ``tokens``. In a round the most
    frequent pairs are replaced together; pairs are chosen so that no symbol begins one
    and ends another, hence occurrences never overlap except in runs of one symbol,
    where every other one counts.
    """
    symbols = tokens.astype(np.int64)
    closing = np.zeros(len(symbols), dtype=bool)
    closing[ends[ends > 0] - 1] = True
    rules: list[tuple[int, int]] = []
    lengths: list[int] = []
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        keys = symbols[:-1] << 32 | symbols[1:]
        slot = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _COUNT_BITS)).view(np.int64)
        open_ = ~closing[:-1]
        counts = np.bincount(slot[open_], minlength=1 << _COUNT_BITS)
        at = np.flatnonzero((counts >= min_count)[slot] & open_)
        if not len(at):
            break
        ordered = np.sort(keys[at])
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
        pairs, n = ordered[first], np.diff(np.r_[first, len(ordered)])
        order = np.argsort(-n, kind="stable")
        order = order[n[order] >= min_count][: 4 * per_round]
        begins, finishes, chosen = set(), set(), []
        for i in order.tolist():
            a, b = int(pairs[i] >> 32), int(pairs[i] & 0xFFFFFFFF)
            if a in finishes or b in begins or (a == b and (a in begins or b in finishes)):
                continue
            begins.add(a)
            finishes.add(b)
            chosen.append((i, a, b))
            if len(chosen) == per_round:
                break
        if not chosen:
            break
        # Most places are ruled out by their two symbols, the rest by their pair.
        wanted = pairs[[i for i, _, _ in chosen]]
        by_key = np.argsort(wanted)
        wanted, new_of = wanted[by_key], base + len(rules) + by_key
        flags = np.zeros(base + len(rules), dtype=np.uint8)
        flags[list(begins)] |= 1
        flags[list(finishes)] |= 2
        spots = at[(flags[symbols[at]] & 1 > 0) & (flags[symbols[at + 1]] & 2 > 0)]
        place = np.minimum(np.searchsorted(wanted, keys[spots]), len(wanted) - 1)
        hit = wanted[place] == keys[spots]
        spots, new = spots[hit], new_of[place[hit]]
        fresh = np.flatnonzero(np.r_[True, np.diff(spots) != 1])
        turn = np.arange(len(spots)) - np.repeat(fresh, np.diff(np.r_[fresh, len(spots)]))
        spots, new = spots[turn % 2 == 0], new[turn % 2 == 0]
        for _, a, b in chosen:
            rules.append((a, b))
            lengths.append(sum(lengths[s - base] if s >= base else 1 for s in (a, b)))
        symbols[spots] = new
        closing[spots] = closing[spots + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[spots + 1] = False
        symbols, closing = symbols[keep], closing[keep]
    where = np.concatenate([[0], np.flatnonzero(closing) + 1])
    filled = np.diff(np.concatenate([[0], ends])) > 0
    symbol_ends = where[np.cumsum(filled)]
    return symbols, symbol_ends, np.array(rules, dtype=np.int64).reshape(-1, 2), np.array(lengths, dtype=np.int64)


def expansions(rules: np.ndarray, base: int) -> list[np.ndarray]:
    """What each rule stands for."""
    out: list[np.ndarray] = []
    for pair in rules.tolist():
        out.append(np.concatenate([out[s - base] if s >= base else np.array([s], dtype=np.int64) for s in pair]))
    return out


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    symbols = symbols.astype(np.int64)
    if not len(rules):
        return symbols
    parts = expansions(rules, base)
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    flat, begins = np.concatenate(parts), np.cumsum(sizes) - sizes
    inner = symbols >= base
    rule = symbols[inner] - base
    lengths = np.ones(len(symbols), dtype=np.int64)
    lengths[inner] = sizes[rule]
    out = np.repeat(symbols, lengths)
    ends = np.cumsum(lengths)
    shift = begins[rule] - (ends[inner] - sizes[rule])
    places = np.flatnonzero(np.repeat(inner, lengths))
    out[places] = flat[places + np.repeat(shift, sizes[rule])]
    return out


def _block_row(shard: int, block: int, before: int, ids: list, rows: list[bytes], base: int) -> dict:
    tokens = np.frombuffer(b"".join(rows), dtype=np.uint32)
    token_ends = np.cumsum([len(r) // 4 for r in rows])
    symbols, symbol_ends, rules, lengths = compress(tokens, token_ends, base)
    wide = bool(base + len(rules) > 1 << 16)
    return {
        "shard": shard, "block": block, "tokens_before": before, "n_tokens": len(tokens), "doc_ids": ids,
        "symbol_ends": symbol_ends, "token_ends": token_ends, "base": base, "wide": wide,
        "rules": rules.astype("<u4").tobytes(), "rule_lengths": lengths.astype("<u4").tobytes(),
        "symbols": symbols.astype("<u4" if wide else "<u2").tobytes(),
    }


def write_blocks(documents: DataFrame, path: str, tokenizer: str, end_id: int, order: str = "doc_id", text: str = "text") -> None:
    """Encode, compress and write all documents in ascending order of their ids."""
    schema = pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("tokens_before", pa.int64()), ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())), ("symbol_ends", pa.list_(pa.int32())), ("token_ends", pa.list_(pa.int32())),
        ("base", pa.int32()), ("wide", pa.bool_()), ("rules", pa.binary()), ("rule_lengths", pa.binary()), ("symbols", pa.binary()),
    ])
    end = np.array([end_id], dtype=np.uint32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, shard = _words(tokenizer), TaskContext.get().partitionId()
        ids: list = []
        rows: list[bytes] = []
        size = block = before = 0
        for batch in batches:
            for first, last in chunk_ranges(text_buffers(batch.column(1))[1], CHUNK_BYTES):
                part = batch.slice(first, last - first)
                encoded = words.encode(part.column(1))
                for i, row in zip(part.column(0).to_pylist(), encoded):
                    if rows and size + len(row) // 4 + 1 > BLOCK_TOKENS:
                        yield pa.RecordBatch.from_pylist([_block_row(shard, block, before, ids, rows, words.size)], schema)
                        block, before, ids, rows, size = block + 1, before + size, [], [], 0
                    ids.append(i)
                    rows.append(row + end)
                    size += len(row) // 4 + 1
        if rows:
            yield pa.RecordBatch.from_pylist([_block_row(shard, block, before, ids, rows, words.size)], schema)

    chosen = documents.select(F.col(order).cast("long").alias("id"), F.col(text).alias("text"))
    ranged = chosen.repartitionByRange(F.col("id")).sortWithinPartitions("id", "text")
    ranged.mapInArrow(run, _BLOCK).write.parquet(path)


def _block_tokens(row: dict) -> np.ndarray:
    symbols = np.frombuffer(row["symbols"], dtype="<u4" if row["wide"] else "<u2")
    return expand(symbols, np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2), row["base"])


def document_tokens(row: dict, index: int) -> np.ndarray:
    """Ids of one document of a block row, without decoding the others."""
    begin = row["symbol_ends"][index - 1] if index else 0
    symbols = np.frombuffer(row["symbols"], dtype="<u4" if row["wide"] else "<u2")[begin : row["symbol_ends"][index]]
    return expand(symbols, np.frombuffer(row["rules"], dtype="<u4").astype(np.int64).reshape(-1, 2), row["base"])


def token_at(row: dict, position: int) -> int:
    """The id at a position of a block, found by the rules' lengths alone."""
    base = row["base"]
    rules = np.frombuffer(row["rules"], dtype="<u4").reshape(-1, 2)
    lengths = np.frombuffer(row["rule_lengths"], dtype="<u4").astype(np.int64)
    symbols = np.frombuffer(row["symbols"], dtype="<u4" if row["wide"] else "<u2").astype(np.int64)
    sizes = np.ones(len(symbols), dtype=np.int64)
    inner = symbols >= base
    sizes[inner] = lengths[symbols[inner] - base]
    ends = np.cumsum(sizes)
    at = int(np.searchsorted(ends, position, side="right"))
    symbol, inside = int(symbols[at]), position - int(ends[at] - sizes[at])
    while symbol >= base:
        left, right = (int(x) for x in rules[symbol - base])
        size = int(lengths[left - base]) if left >= base else 1
        symbol, inside = (left, inside) if inside < size else (right, inside - size)
    return symbol


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and ``ids`` (binary)."""
    return _read(spark, path, with_ids=True)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, with_ids=False)


def _read(spark: SparkSession, path: str, with_ids: bool) -> DataFrame:
    blocks = spark.read.parquet(path)
    # One number per task of the writing job.
    sizes = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum("n_tokens").alias("n")).collect()}
    offsets, total = {}, 0
    for shard in sorted(sizes):
        offsets[shard], total = total, total + sizes[shard]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = _block_tokens(row).astype("<u4")
                ends = np.array(row["token_ends"], dtype=np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                raw = memoryview(tokens.tobytes())
                first = offsets[row["shard"]] + row["tokens_before"]
                parts = [raw[4 * a : 4 * b] for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(first + begins),
                    pa.array(ends - begins),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([bytes(p) for p in parts], pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return blocks.mapInArrow(run, schema)
