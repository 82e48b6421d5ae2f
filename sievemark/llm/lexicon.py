"""Minimal acyclic transducer: words share prefixes and suffixes, outputs are id sequences.

The automaton is the smallest acyclic one for a sorted word list. Every edge carries
the number of accepted words that sort before it, so a walk adds up to the word's
rank, and the rank selects the word's id sequence: outputs do not hinder suffix
sharing. All tables are flat arrays in one file, memory-mapped for reading.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Sequence

import numpy as np

_MAGIC = b"MATLEX1\0"
_PROBES = 8


def slots(keys: np.ndarray, bits: int) -> np.ndarray:
    mult = np.uint64(0x9E3779B97F4A7C15)
    return ((keys.astype(np.uint64) * mult) >> np.uint64(64 - bits)).astype(np.int64)


def hash_table(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Open addressing for distinct non-negative keys: table of keys (-1 free) and of positions."""
    bits = max(4, int(np.ceil(np.log2(max(2, len(keys)) * 8))))
    while True:
        table = np.full((1 << bits) + _PROBES, -1, dtype=np.int64)
        place = np.zeros(len(table), dtype=np.int32)
        rest, home = np.arange(len(keys)), slots(keys, bits)
        for probe in range(_PROBES):
            at = home[rest] + probe
            free = table[at] < 0
            _, first = np.unique(at[free], return_index=True)
            winners = np.flatnonzero(free)[first]
            table[at[winners]] = keys[rest[winners]]
            place[at[winners]] = rest[winners]
            rest = np.delete(rest, winners)
        if not len(rest):
            return table, place, bits
        bits += 1


def find(keys: np.ndarray, table: np.ndarray, place: np.ndarray, bits: int) -> np.ndarray:
    """Positions of keys, -1 where absent."""
    at = slots(keys, bits)
    out = np.full(len(keys), -1, dtype=np.int64)
    probe = 0
    got = table[at]
    hit = got == keys
    out[hit] = place[at[hit]]
    open_ = np.flatnonzero(~hit & (got >= 0))
    while len(open_) and probe < _PROBES - 1:
        probe += 1
        got = table[at[open_] + probe]
        hit = got == keys[open_]
        out[open_[hit]] = place[at[open_[hit]] + probe]
        open_ = open_[~hit & (got >= 0)]
    return out


def compile_words(words: Sequence[bytes], outputs: Sequence[bytes]) -> bytes:
    """File content for distinct non-empty words; outputs are little-endian 32-bit ids."""
    order = sorted(range(len(words)), key=words.__getitem__)
    register: dict[tuple, int] = {}
    children: list[list[tuple[int, int]]] = [[]]  # states kept: their edges, in label order
    final: list[bool] = [False]
    path: list[list] = [[False, []]]  # states of the current word, not yet kept: final, edges

    def keep(state: list) -> int:
        key = (state[0], tuple(state[1]))
        if key not in register:
            register[key] = len(children)
            children.append(state[1])
            final.append(state[0])
        return register[key]

    previous = b""
    for i in order:
        word = words[i]
        shared = 0
        while shared < min(len(word), len(previous)) and word[shared] == previous[shared]:
            shared += 1
        while len(path) > shared + 1:
            state = path.pop()
            path[-1][1].append((previous[len(path) - 1], keep(state)))
        path += [[False, []] for _ in word[shared:]]
        path[-1][0] = True
        previous = word
    while len(path) > 1:
        state = path.pop()
        path[-1][1].append((previous[len(path) - 1], keep(state)))
    final[0], children[0] = path[0]

    accepted = [0] * len(children)
    for state in [*range(1, len(children)), 0]:  # a kept state comes after those it leads to
        accepted[state] = final[state] + sum(accepted[to] for _, to in children[state])
    keys, targets, ranks = [], [], []
    for state, edges in enumerate(children):
        before = int(final[state])
        for label, to in edges:
            keys.append(state << 8 | label)
            targets.append(to)
            ranks.append(before)
            before += accepted[to]
    table, place, bits = hash_table(np.array(keys, dtype=np.int64))
    ids = np.frombuffer(b"".join(outputs[i] for i in order), dtype="<u4")
    ends = np.cumsum([0, *(len(outputs[i]) // 4 for i in order)])
    arrays = [
        table.astype("<i8"), place.astype("<i4"), np.array(targets, "<i4"), np.array(ranks, "<i4"),
        np.array(final, "u1"), ends.astype("<i4"), ids,
    ]
    head = _MAGIC + struct.pack("<i", bits) + struct.pack("<7q", *(len(a) for a in arrays))
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


class Lexicon:
    """A compiled lexicon, read where it lies."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        if self._map[:8] != _MAGIC:
            raise ValueError(f"not a lexicon: {path}")
        (self._bits,) = struct.unpack_from("<i", self._map, 8)
        counts, at, arrays = struct.unpack_from("<7q", self._map, 12), 68, []
        for count, kind in zip(counts, ("<i8", "<i4", "<i4", "<i4", "u1", "<i4", "<u4")):
            array = np.frombuffer(self._map, dtype=kind, count=count, offset=at)
            arrays.append(array)
            at += array.nbytes + -array.nbytes % 8
        self._table, self._place, self._targets, self._ranks, self._final, self._ends, self._ids = arrays

    @property
    def size(self) -> int:
        return len(self._ends) - 1

    @property
    def n_states(self) -> int:
        return len(self._final)

    def ranks(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Rank of each word (a span of ``data``) in the lexicon, -1 where it has none. All words walk together."""
        out = np.full(len(starts), -1, dtype=np.int64)
        if not len(self._targets):
            return out
        alive = np.flatnonzero(sizes > 0)
        state, rank, depth = np.zeros(len(alive), np.int64), np.zeros(len(alive), np.int64), 0
        while len(alive):
            edge = find(state << 8 | data[starts[alive] + depth], self._table, self._place, self._bits)
            ok = edge >= 0
            alive, edge = alive[ok], edge[ok]
            state, rank, depth = self._targets[edge].astype(np.int64), rank[ok] + self._ranks[edge], depth + 1
            ended = sizes[alive] == depth
            accepted = ended & (self._final[state] > 0)
            out[alive[accepted]] = rank[accepted]
            alive, state, rank = alive[~ended], state[~ended], rank[~ended]
        return out

    def outputs(self, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words of these ranks, one after the other, and how many each has."""
        sizes = (self._ends[ranks + 1] - self._ends[ranks]).astype(np.int64)
        shift = np.repeat(self._ends[ranks] - (np.cumsum(sizes) - sizes), sizes)
        return self._ids[shift + np.arange(len(shift))], sizes
