"""Language identification by cross-parsing entropy.

Each language is a suffix automaton of labelled text. A document is parsed
greedily into the longest phrases that occur in that text; the fewer phrases, the
better the language explains the document. Phrase counts are normalised by the
log of the training length, which makes them estimates of cross entropy, and the
lowest wins.

Texts are reduced to lower-case letters with single spaces between letter runs and
parsed whole, in segments of ``SEGMENT`` symbols: all segments of a task advance
together, one symbol per numpy step.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; with no
labelled text at all every document is ``und``; equal scores go to the language that
comes first by code point; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemark.llm.columns import without

SEGMENT = 256
CHUNK_SYMBOLS = 1 << 21
UNDETERMINED = "und"

_SPACE, _RARE, _PAD, _FIRST = 0, 1, 2, 3
_MAX_LETTERS = 120


def training_texts(
    labelled: DataFrame,
    text: str = "text",
    language: str = "lang",
    order: str = "doc_id",
    max_chars: int = 24_000,
    max_document: int = 4_000,
) -> dict[str, str]:
    """A bounded sample of labelled text per language: at most ``max_chars`` characters.

    Documents are drawn by hash: a share of each language that should hold twice the
    bound, then the first of them in hash order. ``max_document`` bounds what one
    document adds. Only the automata are fitted on the sample; predictions read whole
    texts.
    """
    known = labelled.where(F.col(language).isNotNull() & (F.length(text) > 0))
    usable = F.least(F.length(text), F.lit(max_document))
    sizes = {r[0]: r[1] for r in known.groupBy(language).agg(F.sum(usable)).collect()}
    if not sizes:
        return {}
    draw = (F.xxhash64(F.col(order).cast("string"), F.lit("language")) % 1_000_000 + 1_000_000) % 1_000_000
    whole = F.create_map(*[F.lit(x) for k, v in sizes.items() for x in (k, min(1.0, 2.0 * max_chars / v + 0.0005))])
    sample = known.where(draw < F.element_at(whole, F.col(language)) * 1_000_000)
    rows = sample.select(language, F.substring(text, 1, max_document).alias("t"), draw.alias("d"), F.col(order).alias("o"))
    parts: dict[str, list[str]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r[0], r[2], str(r[3]), r[1])):
        parts.setdefault(row[0], []).append(row[1])
    texts = {k: "\n".join(v)[:max_chars] for k, v in parts.items()}
    missing = [k for k in sizes if k not in texts]
    for name in missing:  # too few documents for the draw: take the language's first ones
        first = known.where(F.col(language) == name).orderBy(draw, order).limit(8).collect()
        texts[name] = "\n".join(r[text][:max_document] for r in first)[:max_chars]
    return dict(sorted(texts.items()))


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the minimal automaton of all substrings; state 0 is the start."""
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for symbol in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = moves[at][symbol]
            if length[at] + 1 == length[target]:
                link[new] = target
            else:
                twin = len(moves)
                moves.append(dict(moves[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                link[target] = link[new] = twin
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = twin
                    at = link[at]
        last = new
    return moves


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For every code point: is it a letter?"""
    return np.frombuffer(bytes(chr(c).isalpha() for c in range(0x110000)), dtype=bool)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _symbols(text: str, alphabet: np.ndarray) -> np.ndarray:
    """Symbols of a text: runs of anything but letters become one space."""
    codes = alphabet[_points(text)]
    keep = codes != _SPACE
    keep[1:] |= codes[:-1] != _SPACE
    return codes[keep]


class Parser:
    """Automata of all languages over one alphabet."""

    def __init__(self, texts: tuple[tuple[str, str], ...]):
        self.names = [name for name, _ in texts]
        points, counts = np.unique(np.concatenate([_points(t) for _, t in texts]), return_counts=True)
        letter = _letters()[points]
        points, counts = points[letter], counts[letter]
        common = points[np.argsort(-counts, kind="stable")][:_MAX_LETTERS]
        self.alphabet = np.where(_letters(), np.uint8(_RARE), np.uint8(_SPACE))
        self.alphabet[common] = np.arange(_FIRST, _FIRST + len(common), dtype=np.uint8)
        self.width = _FIRST + len(common)
        self.tables, self.logs = [], []
        for _, text in texts:
            symbols = _symbols(text, self.alphabet)
            moves = suffix_automaton(symbols.tolist())
            table = np.zeros((len(moves) + 1, self.width), dtype=np.int32)
            for state, row in enumerate(moves):
                table[state, list(row.keys())] = list(row.values())
            table[:, _RARE] = 0
            table[:, _PAD] = len(moves)  # behind a segment's end nothing counts
            self.tables.append(table.ravel() * np.int32(self.width))
            self.logs.append(np.log2(max(2, len(symbols))))

    def phrases(self, columns: np.ndarray) -> np.ndarray:
        """Phrases per language and segment; ``columns`` holds one symbol of all segments per row."""
        counts = np.zeros((len(self.tables), columns.shape[1]), dtype=np.int64)
        for table, count in zip(self.tables, counts):
            state = np.zeros(columns.shape[1], dtype=np.int32)
            for symbols in columns:
                after = table[state + symbols]
                ended = after == 0
                # A phrase begins at the start state, and where the one before cannot go on.
                count += (ended | (state == 0)) & (symbols != _PAD)
                state = np.where(ended, table[symbols], after)
        return counts

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross entropy per text and language, in bits per symbol, and whether the text has a letter."""
        streams = [_symbols(t, self.alphabet) for t in texts]
        sizes = np.array([len(s) for s in streams])
        spelled = np.array([bool((s != _SPACE).any()) for s in streams])
        pieces = -(-sizes // SEGMENT)
        bounds = np.concatenate([[0], np.cumsum(pieces)])
        grid = np.full((bounds[-1], SEGMENT), _PAD, dtype=np.uint8)
        flat = grid.ravel()
        for stream, at in zip(streams, bounds):
            flat[at * SEGMENT : at * SEGMENT + len(stream)] = stream
        counts = self.phrases(np.ascontiguousarray(grid.T).astype(np.int32))
        running = np.concatenate([np.zeros((len(counts), 1), np.int64), np.cumsum(counts, axis=1)], axis=1)
        per_text = running[:, bounds[1:]] - running[:, bounds[:-1]]
        return per_text.T * np.array(self.logs) / np.maximum(1, sizes)[:, None], spelled


@lru_cache(maxsize=1)
def _parser(texts: tuple[tuple[str, str], ...]) -> Parser:
    return Parser(texts)


def identify(documents: DataFrame, training: dict[str, str], text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (how far the second language lies behind, 0 to 1)."""
    texts = tuple(sorted((k, v) for k, v in training.items() if v))
    kind = "lang_pred string, score double"

    @F.pandas_udf(kind)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(_predictions(batch.fillna("").tolist(), texts), columns=["lang_pred", "score"])

    documents = without(documents, "lang_pred", "score")
    names = documents.columns
    result = documents.withColumn("__language", predict(F.col(text)))
    return result.select(*names, F.col("__language.lang_pred").alias("lang_pred"), F.col("__language.score").alias("score"))


def _predictions(values: list[str], texts: tuple[tuple[str, str], ...]) -> list[tuple[str, float]]:
    if not texts:
        return [(UNDETERMINED, 0.0)] * len(values)
    parser, out, at = _parser(texts), [], 0
    while at < len(values):
        end, size = at, 0
        while end < len(values) and (end == at or size + len(values[end]) <= CHUNK_SYMBOLS):
            size += len(values[end])
            end += 1
        entropy, spelled = parser.scores(values[at:end])
        best = entropy.argmin(axis=1)
        lowest = entropy[np.arange(len(best)), best]
        if entropy.shape[1] > 1:
            second = np.partition(entropy, 1, axis=1)[:, 1]
            score = 1 - lowest / np.where(second > 0, second, 1)
        else:
            score = np.ones(len(best))
        out += [
            (parser.names[b], float(s)) if ok else (UNDETERMINED, 0.0) for b, s, ok in zip(best, score, spelled)
        ]
        at = end
    return out


def fold(order: Column, folds: int) -> Column:
    """crc32 of an id, as text, modulo ``folds``."""
    return F.crc32(F.coalesce(order.cast("string"), F.lit(""))) % folds


