"""Whole texts as numpy arrays: word spans and word hashes straight from Arrow buffers.

No Python object is made per word. Work goes by chunks of documents, so that the
arrays of a task stay small however large an Arrow batch is; a single document
longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 18

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: White space and ASCII punctuation.
PUNCTUATED = _SPACE.copy()
PUNCTUATED[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True

_generator = np.random.default_rng(20240229)
_BYTE_CODE = _generator.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_RADIX = np.uint64(0x9E3779B97F4A7C15 | 1)
_UNRADIX = np.uint64(pow(int(_RADIX), -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _folded_codes() -> np.ndarray:
    """Codes under which A-Z equal a-z."""
    codes = _BYTE_CODE.copy()
    codes[0x41:0x5B] = codes[0x61:0x7B]
    return codes


_FOLDED_CODE = _folded_codes()


def _power_table(base: np.uint64, size: int) -> np.ndarray:
    known = _powers.get(int(base))
    if known is None or len(known) < size:
        steps = np.full(max(size, CHUNK_BYTES + 1), base, dtype=np.uint64)
        steps[0] = 1
        known = _powers[int(base)] = np.multiply.accumulate(steps)
    return known[:size]


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    z = values.astype(np.uint64, copy=True)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each text; null counts as empty."""
    column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)
    first = first[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[first[0] : first[-1]], first - first[0]


def chunk_ranges(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most ``limit`` bytes together (or one document)."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(n, max(end, at + 1))
        yield at, end
        at = end


def word_spans(
    data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the words (``[^\\x20\\x09-\\x0D]+`` by default) and, per document, where its words begin."""
    solid = ~separators[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:-1]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of byte spans; ``fold`` treats A-Z as a-z."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    codes = (_FOLDED_CODE if fold else _BYTE_CODE)[data]
    codes *= _power_table(_RADIX, len(data))
    np.cumsum(codes, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * _power_table(_UNRADIX, len(data) + 1)[starts])


def document_words(
    column: pa.Array, fold: bool = True, separators: np.ndarray = _SPACE
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By chunks: first document, its word hashes, and where each document's words begin."""
    data, offsets = text_buffers(column)
    for first, last in chunk_ranges(offsets):
        own = data[offsets[first] : offsets[last]]
        starts, ends, bounds = word_spans(own, offsets[first : last + 1] - offsets[first], separators)
        yield first, span_hashes(own, starts, ends, fold), bounds


def hash_of(word: str) -> int:
    """The hash that ``document_words`` gives a word."""
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])
