"""Counts against the library that the vocabulary file is for."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starmill.llm import token_counts
from test_bpe import ALPHABET

PATH = public_tokenizers.path("word_bpe_49k.json")
MORE = ["<|startoftext|>", "<|ENDOFTEXT|>", "Σ", "ΑΣ", "İ", "ǅ", "é", "́", "ﬁ", "\x1c", "​",
        " ", "Ⅷ", "²", "WE'LL", "'S", "한국어", "ㅎㅏㄴ", "՘", "꟎", "𐥀", "<|endoftext|><|endoftext|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return token_counts.Counter(PATH)


def expected(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def test_counts_equal_the_library(library, counter):
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice(ALPHABET + MORE) for _ in range(rng.randint(0, 40)))
        assert counter.count(text) == expected(library, text), repr(text)


def test_every_kind_of_character(library, counter):
    """Every character up to U+2FFF, and one of each 16 above, between letters and digits."""
    points = [*range(0x3000), *range(0x3000, 0x110000, 16)]
    texts = [f"A{chr(c)}b1{chr(c)} {chr(c)}." for c in points if not 0xD800 <= c < 0xE000]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        assert counter.count(text) == len(found.ids), repr(text)


def test_long_words_and_long_texts(library, counter, monkeypatch):
    rng = random.Random(5)
    for word in ("a" * 5001, "é" * 900, "".join(rng.choice("abcdefgh") for _ in range(4000)), "=" * 3001):
        assert counter.count(word) == expected(library, word)
    monkeypatch.setattr(token_counts, "PIECE", 9)
    text = "It's a truth,  universally\tacknowledged ́é <|endoftext|> x中文 ÀÉ.\n\n " * 30
    assert counter.count(text) == expected(library, text)
    assert "".join(token_counts._cut(text)) == text


def test_a_full_table_starts_anew(library, counter, monkeypatch):
    monkeypatch.setattr(token_counts, "WORDS", 5)
    text = " ".join(f"word{i}x{i % 3}" for i in range(40))
    assert counter.count(text) == expected(library, text)
    assert len(counter.known) <= 5


def test_odd_rows(library, odd, clashing, none, odd_rows):
    counts = [(d, len((t or "").encode()), expected(library, t or "")) for d, t, *_ in odd_rows]
    want = sorted((str(d), b, n, n > 2048) for d, b, n in counts)
    assert {w[3] for w in want} == {True, False}
    for df in (odd, clashing):
        assert sorted((str(r[0]), *r[1:]) for r in token_counts.token_counts(df, PATH).collect()) == want
    assert token_counts.token_counts(none, PATH).count() == 0
