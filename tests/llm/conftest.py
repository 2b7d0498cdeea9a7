import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_corpus import SCHEMA, words  # noqa: E402

LONG = " ".join(f"word{i % 977} thing{i % 13}" for i in range(30_000))
#: Extra columns whose names the operators use themselves.
CLASHES = ("file", "row", "Words", "digest", "kept", "fingerprint", "root", "score", "lang_pred",
           "start", "parts", "dedup_file", "simhash_row", "secret_spots", "_metadata", "queue")

ODD_ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \t\n ", None, None, 4),
    (4, "the same text twice over", "en", "a", 24),
    (5, "the same text twice over", "en", "b", 24),
    (5, "the same text twice over", "en", "b", 24),
    (6, LONG, "en", "a", len(LONG)),
    (None, "an id is missing here", "en", "a", 21),
    (None, None, None, None, None),
    (7, "é ñ 中文 😀 \u0001 \x00 <|endoftext|> don't", "fr", "c", 10),
    (8, 'login password=7602ad27cf5550de1c and token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"',
     "en", "a", 80),
]


@pytest.fixture(scope="session")
def odd_rows():
    return ODD_ROWS


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows."""
    return spark.createDataFrame(ODD_ROWS, SCHEMA)


@pytest.fixture(scope="module")
def clashing(odd):
    """``odd`` with extra columns named like the operators' own."""
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def corpus(spark):
    """300 documents of three languages and three sources, with copies."""
    rng = random.Random(5)
    rows = []
    for i in range(300):
        language = ("aa", "bb", "cc")[i % 3]
        text = words(language, rng.randint(20, 120), rng)
        rows.append((i, text, language, f"s{min(i % 7, 2)}", len(text)))
    for i in range(300, 330):
        rows.append((i, *rows[i - 300][1:]))
    return spark.createDataFrame(rows, SCHEMA)
