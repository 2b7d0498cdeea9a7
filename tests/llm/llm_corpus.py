"""Invented documents for the tests, and what holds for every packing."""

import zlib

import numpy as np
from pyspark.sql import types as T
from tokenizers import Tokenizer

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])


def words(language, n, rng):
    """Invented words; the languages differ in their letters' frequencies."""
    parts = {"aa": "ka lo mi tu ne ra", "bb": "sch ung ver der ein ich", "cc": "éa çon ier oux tre"}
    return " ".join("".join(rng.choice(parts[language].split()) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


def grams(text):
    """The text's distinct five-word shingles; fewer words are one."""
    found = text.lower().split()
    return {tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def packed_whole(pieces, texts, path, window=2048):
    """Every document's ids lie in exactly one piece each, and windows have no gaps."""
    tokenizer = Tokenizer.from_file(path)
    total = 0
    by_doc, by_window = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_window.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(parts, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            at += p.length
            assert zlib.crc32(ids[p.start:at].tobytes()) == p.ids_crc32
        assert at == len(ids)
        total += at
    sizes = []
    for number in range(len(by_window)):
        at = 0
        for p in sorted(by_window[number], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        sizes.append(at)
    full = total // window
    assert sizes[:full] == [window] * full
    assert all(n & (n - 1) == 0 and n < window for n in sizes[full:]) and sum(sizes) == total
