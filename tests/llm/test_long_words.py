"""Counts of very long words against the tokenizers library."""

import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pathwake.llm import token_counts

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_BPE)


def count(text):
    return int(token_counts.counter_of(WORD_BPE).counts([text])[0])


def texts():
    rng = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyz"
    yield "".join(rng.choice(letters) for _ in range(60_000))
    yield "".join(rng.choice(["the", "ing", "photo", "un", "s", "日本", "é"]) for _ in range(15_000))
    for piece in ("a", "ab", "abc", "xyzzy", "ha", "é", "日"):
        yield piece * (40_000 // len(piece))
    yield "!?" * 20_000
    yield "z" * 5041 + "q" + "th" * 9000


@pytest.mark.parametrize("text", list(texts()), ids=range(11))
def test_long_words(library, text):
    assert count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_chunks_agree_with_one_go():
    words = token_counts.counter_of(WORD_BPE).words
    rng = random.Random(2)
    for _ in range(3):
        word = "".join(rng.choice("aehinorst") for _ in range(rng.randrange(6000, 9000))).encode()
        whole = words._steps([word], np.array([len(word)]), np.ones(1, dtype=bool))[2][0]
        for chunk, overlap in ((700, 400), (1680, 840)):
            assert words._scanned(word, chunk, overlap) in (None, whole)
        assert words._scanned(word, 1680, 840) == whole


def test_a_word_of_a_megabyte(library):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(1_000_000))
    start = time.perf_counter()
    found = count(text)
    assert time.perf_counter() - start < 60  # some seconds on a free core
    assert found == len(library.encode(text, add_special_tokens=False).ids)
