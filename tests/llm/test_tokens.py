"""Token ids: transducer BPE and Re-Pair blocks against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sievemark.llm import bpe, repair
from sievemark.llm.lexicon import Lexicon, compile_words

SCHEMA = "doc_id long, text string, ids string"
BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = [
    "a", "The", "the", " ", "  ", "\n", "\t", "'s", "'LL", "'ll", "é", "É", "ß", "1", "²", "aaaa", "!!", "<|endoftext|>",
    "<|startoftext|>", "😀", "\u00a0", "\u2028", "\x1c", "漢", "e\u0301", "İ", "Σ", "\u3000", "'", "x" * 50, "-", "\r\n",
]


def _texts(seed, n):
    rng = random.Random(seed)
    out = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(n)]
    return out + ["a" * 3000, "ab" * 2000, " " * 700, "é" * 900, "", " ", "the cat"]


def test_encoder_equals_the_library():
    library, tables = Tokenizer.from_file(BYTE), bpe._tables(bpe._content(BYTE))
    encoder = bpe.Encoder(tables, None)
    texts = _texts(1, 3000)
    for text, row in zip(texts, encoder.encode(texts)):
        ids = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(row, "<u4").tolist() == ids, repr(text)
        assert bpe.decode_rows(tables, [row]) == [library.decode(ids, skip_special_tokens=False)]


def test_full_caches_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 5)
    monkeypatch.setattr(repair, "CACHED_WORDS", 5)
    texts = [f"w{i} the cat{i} w{i % 7}" for i in range(60)]
    encoder, words = bpe.Encoder(bpe._tables(bpe._content(BYTE)), None), repair.Words(WORD)
    for own, path in ((encoder, BYTE), (words, WORD)):
        library = Tokenizer.from_file(path)
        for _ in range(2):
            rows = [row for t in texts for row in own.encode([t])]
            assert [np.frombuffer(r, "<u4").tolist() for r in rows] == [library.encode(t).ids for t in texts]


def test_lexicon_is_minimal_and_exact(tmp_path):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 7))).encode() for _ in range(500)})
    rng.shuffle(words)
    outputs = [np.arange(len(w), dtype="<u4").tobytes() * (1 + i % 3) for i, w in enumerate(words)]
    path = tmp_path / "lexicon.bin"
    path.write_bytes(compile_words(words, outputs))
    lexicon = Lexicon(str(path))
    asked = [*words, b"zz", b"", b"a" * 9]
    sizes = np.array([len(w) for w in asked])
    ranks = lexicon.ranks(np.frombuffer(b"".join(asked), np.uint8), np.cumsum(sizes) - sizes, sizes)
    assert sorted(ranks[: len(words)]) == list(range(len(words)))
    assert (ranks[len(words) :] == -1).all()
    flat, counts = lexicon.outputs(ranks[: len(words)])
    assert flat.astype("<u4").tobytes() == b"".join(outputs) and (counts == [len(o) // 4 for o in outputs]).all()
    suffixes = {frozenset(w[k:] for w in words if w.startswith(p)) for w in words for k in range(len(w) + 1) for p in [w[:k]]}
    assert lexicon.n_states == len(suffixes)  # one state per distinct set of continuations


def test_digests_of_documents(spark):
    rows = [(i, t, "x") for i, t in enumerate(_texts(3, 300))] + [(9001, None, None), (9001, None, None), (None, "the cat", None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    library = Tokenizer.from_file(BYTE)
    got = sorted(map(tuple, bpe.digests(df, BYTE).collect()), key=repr)

    def expected(i, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        return i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    assert got == sorted((expected(i, t) for i, t, _ in rows), key=repr)


def test_encode_and_decode_keep_columns(spark):
    df = spark.createDataFrame([(1, "the cat", "own"), (2, None, None)], SCHEMA)
    encoded = bpe.encode(df, BYTE)
    assert encoded.columns == ["doc_id", "text", "ids"]  # the operator's column replaces one of the same name
    back = {r.doc_id: r.decoded for r in bpe.decode(encoded, BYTE).collect()}
    assert back == {1: "the cat", 2: ""}
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(empty, BYTE).count() == 0 and bpe.digests(empty, BYTE).count() == 0


def test_word_ids_equal_the_library():
    library, words = Tokenizer.from_file(WORD), repair.Words(WORD)
    texts = _texts(4, 3000)
    for text, row in zip(texts, words.encode(texts)):
        assert np.frombuffer(row, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("seed", range(4))
def test_compressed_blocks_expand_exactly(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(0, 60, 300)
    tokens = rng.choice([1, 2, 3, 3, 3, 7, 900], sizes.sum()).astype(np.uint32)
    ends = np.cumsum(sizes)
    symbols, symbol_ends, rules, lengths = repair.compress(tokens, ends, 1000, rounds=6, per_round=3, min_count=2)
    assert len(symbols) < len(tokens) and len(rules)
    assert (repair.expand(symbols, rules, 1000) == tokens).all()
    assert [len(x) for x in repair.expansions(rules, 1000)] == lengths.tolist()
    begins = np.concatenate([[0], symbol_ends[:-1]])
    for k, (a, b) in enumerate(zip(begins, symbol_ends)):
        assert (repair.expand(symbols[a:b], rules, 1000) == tokens[ends[k] - sizes[k] : ends[k]]).all()


def test_blocks_written_and_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_TOKENS", 400)
    rows = [(7 * i % 301, t, "x") for i, t in enumerate(_texts(5, 290))] + [(500, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    repair.write_blocks(df, str(tmp_path / "blocks"), WORD, end_id=2)
    library, start, expected = Tokenizer.from_file(WORD), 0, []
    for i, text in sorted(((i, t or "") for i, t, _ in rows)):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        raw = np.array(ids, "<u4").tobytes()
        expected.append((i, start, len(ids), zlib.crc32(raw), bytearray(raw)))
        start += len(ids)
    got = sorted(map(tuple, repair.read_documents(spark, str(tmp_path / "blocks")).collect()))
    assert got == sorted(expected)
    block = spark.read.parquet(str(tmp_path / "blocks")).orderBy("shard", "block").first().asDict()
    tokens = np.frombuffer(b"".join(e[4] for e in expected[: len(block["doc_ids"])]), "<u4")
    assert all(repair.token_at(block, k) == tokens[k] for k in range(len(tokens)))
    last = len(block["doc_ids"]) - 1
    assert repair.document_tokens(block, last).astype("<u4").tobytes() == bytes(expected[last][4])


def test_blocks_of_nothing(spark, tmp_path):
    repair.write_blocks(spark.createDataFrame([], SCHEMA), str(tmp_path / "none"), WORD, end_id=2)
    assert repair.read_digests(spark, str(tmp_path / "none")).count() == 0
