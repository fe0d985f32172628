"""The word encoder against the library's plain call on an unaltered tokenizer."""

import struct

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from usageloom.llm import encoders
from usageloom.llm.encoders import WordBpe, word_bpe

WORDS = public_tokenizers.path("word_bpe_49k.json")


def ids(text, **how):
    found = word_bpe(WORDS, **how).encode(text)
    return list(struct.unpack(f"<{len(found) // 4}I", found))


@pytest.mark.parametrize("text", [
    "", "Two words, and more.", "it's 12 o'clock", "schöne Größe\n\nñ", "a < b |> c", "日本語 x",
    "a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", " <|endoftext|>\n", "x <|EndOfText|> y",
    "<|endoftext|", "Word<|startoftext|>Word.", "\x1c<|endoftext|>\x1d", "e\u0301<|endoftext|>\u0301",
])
def test_ids_are_those_of_the_plain_call(text):
    assert ids(text) == Tokenizer.from_file(WORDS).encode(text, add_special_tokens=False).ids


def test_a_guarded_encoder_reads_special_tokens_as_text():
    plain = Tokenizer.from_file(WORDS)
    for token in ("<|endoftext|>", "<|startoftext|>"):
        special = plain.token_to_id(token)
        assert special in ids(f"a {token} b") and special not in ids(f"a {token} b", guarded=True)
        assert len(ids(token, guarded=True)) > 1
    assert ids("Two words, and more.", guarded=True) == ids("Two words, and more.")


ODD = ["", "Two words, and more.", "it's 12 o'clock", "", "schöne Größe\n\nñ É,é.É ß", "日本語 x ªº µ", "x <|EndOfText|> y --x x--y",
       "a<|endoftext|>b, a", "\x1c<|endoftext|>\x1d", "e\u0301 İ ſ Σς", "A" * 70 + ".", " \n ", "WORD word Word, word... </w>"]


@pytest.mark.parametrize("at_once", [1, 7, 1 << 18])
@pytest.mark.parametrize("units", [3, 1000])
def test_many_texts_at_once_have_the_ids_of_the_plain_call(monkeypatch, at_once, units):
    monkeypatch.setattr(encoders, "AT_ONCE", at_once)
    encoder, plain = WordBpe(WORDS, units=units), Tokenizer.from_file(WORDS)
    for texts in (ODD, ODD[::-1], [], [""], ["", ""], ODD):
        found, ends = encoder.encode_all(texts)
        parts = [found[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends)]
        assert parts == [plain.encode(text, add_special_tokens=False).ids for text in texts]
        assert len(encoder.known) <= units


def test_a_word_is_merged_once_however_it_is_written(monkeypatch):
    words = ["".join(chr(97 + i // 26 ** k % 26) for k in range(4)) for i in range(0, 26 ** 4, 229)]
    texts = [text for word in words for text in (word, word.upper(), f"{word}, {word.title()}.")]
    merged, alone = [], []
    find_words, find = WordBpe._find_words, WordBpe._find
    monkeypatch.setattr(WordBpe, "_find_words", lambda self, some: merged.append(some) or find_words(self, some))
    monkeypatch.setattr(WordBpe, "_find", lambda self, unit: alone.append(unit) or find(self, unit))
    encoder = WordBpe(WORDS)
    first, _ = encoder.encode_all(texts)
    assert [sorted(some) for some in merged] == [sorted(words)] and sorted(alone) == ["", ",", "."]
    again, _ = encoder.encode_all(texts[::-1])
    assert merged[1:] == [[]] and len(alone) == 3 and again.size == first.size


def test_words_of_a_vocabulary_without_word_ends(tmp_path):
    from tokenizers import models, pre_tokenizers

    tokenizer = Tokenizer(models.BPE(vocab={"a": 0, "b": 1, "ab": 2}, merges=[("a", "b")]))
    tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
    tokenizer.save(f"{tmp_path}/plain.json")
    found, ends = WordBpe(f"{tmp_path}/plain.json").encode_all(["ab ba", "aab"])
    assert found.tolist() == [2, 1, 0, 0, 2] and ends.tolist() == [3, 5] and np.dtype("<u4") == found.dtype
