"""Words of the Re-Pair encoder: met late, spelled oddly, and in sliced columns."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from sievemark.llm import repair

WORD = public_tokenizers.path("word_bpe_49k.json")


class _Counted:
    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, word):
        self.asked.append(word)
        return self.model.tokenize(word)


def test_words_met_after_the_table_is_full_are_kept_too(monkeypatch):
    monkeypatch.setattr(repair, "CACHED_WORDS", 8)
    words = repair.Words(WORD)
    words.model = model = _Counted(words.model)
    for letter in "abcdefghijklmnopqrst":
        words.encode([letter * 9])
    rows = [words.encode(["zebras"])[0] for _ in range(3)]
    assert model.asked.count("zebras") == 1 and len(set(rows)) == 1


def test_marks_digits_and_accents_within_words_equal_the_library():
    library, words = Tokenizer.from_file(WORD), repair.Words(WORD)
    texts = ["nd%%% a's''s 'LL'll x1'RE2", "Ärger's ÿß×÷ Éa!!b", "<|endoftext|>a <|ENDOFTEXT|> a<b|>", "a.b@C-d.com\ta\r\nb", None, ""]
    column = pa.array(["skipped", *texts]).slice(1)
    for text, row in zip(texts, words.encode(column)):
        assert np.frombuffer(row, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)
