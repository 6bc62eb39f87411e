"""Ids of the word vocabulary against the library, on whole texts."""

from __future__ import annotations

import json
import random

import public_tokenizers
import pytest

from billweave.llm.packing import WordIds

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def word_ids():
    return WordIds(WORDS)


def test_every_vocabulary_entry_as_a_word(word_ids):
    with open(WORDS, encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    words = [t.removesuffix("</w>") for t in vocabulary if t.removesuffix("</w>").isascii()]
    assert len(words) > 40_000
    assert [w for w in words if word_ids.ids(w) != word_ids.library_ids(w)] == []


def test_whole_texts_equal_the_library(word_ids):
    rng = random.Random(11)
    plain = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F)]]
    parts = ["the ", "'s", "'LL ", "VALİ, ", "ing", "tion", "1", "23", ". ", "||", "--", "don't", "é", "ß"]
    odd = ["Σ", "ς ", "漢字", "̇", "\x85", "\xa0", "<|endoftext|>", "🙂", "\U0010ffff", "\x1f", " ", "é", "Ω", "ﬁ"]
    seen = 0
    for k in range(8000):
        chosen = parts + odd if k % 4 == 0 else parts
        text = "".join(rng.choice(plain) if rng.random() < 0.3 else rng.choice(chosen) for _ in range(rng.randint(1, 30)))
        seen += word_ids.is_plain(text)
        assert word_ids.ids(text) == word_ids.library_ids(text), text
    assert 4000 < seen < 8000
    assert word_ids.ids("") == word_ids.ids(" \n\t") == b""
    long_ = "wordy VALİ, 2. " * 20_000
    assert word_ids.ids(long_) == word_ids.library_ids(long_)


def test_other_vocabularies_are_refused():
    with pytest.raises((ValueError, TypeError)):
        WordIds(BYTES)
