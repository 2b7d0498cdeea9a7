import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from starmill.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "1", "23", "é", "ß", "中文", "😀", "\xa0",
            "\t", "\r\n", "<|endoftext|>", "<|", "_", "-", "!!", "́", "‍", "\x00", "\x85",
            "　", "the", " quick", "ing", "a" * 50, "=" * 30]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(PATH)


def ids(reference, text):
    return reference.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(reference, codec):
    rng = random.Random(1)
    texts = ["", "<|endoftext|>", "a'", "'s"] + [
        "".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 40))) for _ in range(1500)]
    for text, found in zip(texts, codec.encode(texts)):
        want = ids(reference, text)
        assert found.tolist() == want, text
        assert codec.decode(want) == reference.decode(want, skip_special_tokens=False)


def test_long_words_and_long_texts(reference, codec, monkeypatch):
    rng = random.Random(2)
    long_words = ["".join(rng.choice("abcdefgh") for _ in range(3000)), "a" * 2501, "é" * 900]
    for word in long_words:
        assert codec.encode([word])[0].tolist() == ids(reference, word)
    monkeypatch.setattr(bpe, "PIECE", 100)
    monkeypatch.setattr(bpe, "SPAN", 7)
    text = "It is a truth, universally acknowledged; that 1234 people's <|endoftext|> x.\n\n " * 30
    assert codec.encode(["b", text, ""])[1].tolist() == ids(reference, text)


def test_a_full_table_starts_anew(reference, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS", 10)
    codec = bpe.Codec(PATH)
    for i in range(20):
        text = " ".join(f"word{i}x{j}" for j in range(8))
        assert codec.encode([text])[0].tolist() == ids(reference, text)


def test_odd_rows(reference, odd, clashing, none, odd_rows):
    want = sorted(
        (str(d), len(ids(reference, t or "")),
         hashlib.sha256(",".join(map(str, ids(reference, t or ""))).encode()).hexdigest(),
         hashlib.sha256((t or "").encode()).hexdigest())
        for d, t, *_ in odd_rows)
    for df in (odd, clashing):
        assert sorted((str(r[0]), *r[1:]) for r in bpe.digests(df, PATH).collect()) == want
    assert bpe.digests(none, PATH).count() == 0


def test_round_trip(odd, odd_rows):
    back = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted(
        (str(d), t or "") for d, t, *_ in odd_rows)
