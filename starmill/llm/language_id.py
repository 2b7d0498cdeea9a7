"""Language identification: sparse multinomial logistic regression on character n-grams.

1. Document frequencies of hashed n-grams (1 to 3 characters, letters lower-cased, all else one
   space) are counted over the whole texts of all documents that may be learned from.
2. A sample of labelled documents by a hash of the id gives TF-IDF vectors: of each language all
   documents, or about ``per_language``, or with many languages an equal share of ``rows``, but not
   below ``least``. Every label is learned. Tasks make the vectors; should they take more than
   ``size`` bytes, each language keeps those of the smallest hashes up to its share, so the driver holds
   a bounded amount. Follow-the-regularised-leader with elastic-net penalties fits the weights; the L1
   part leaves most of them at zero.
3. One fold of the sample is left out of the fit and sets the softmax's temperature.
4. Every document is scored by a narrow map; the weights (languages x buckets) travel with the job.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is everything when
no row can be learned from. Null ids are held out. Rows whose language is null are only predicted.
Very long texts are counted ``CHUNK`` characters at a time. Ties go to the language that sorts first. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.common import free_names, learning_fold, named, text_batches
from starmill.session import stored

UNKNOWN = "und"
BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
CHUNK = 1 << 20
PER_LANGUAGE, SAMPLE_ROWS, LEAST, SAMPLE_BYTES = 800, 20_000, 50, 256 << 20
CALIBRATION_FOLD = 1
MIXER = np.uint64(0x9E3779B97F4A7C15)

_SCORED = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # languages x (buckets + 1); the last column is the bias
    temperature: float


def letter_table() -> np.ndarray:
    """For each code point, itself where it is a letter, otherwise the space."""
    points = np.arange(0x110000, dtype=np.uint32)
    letters = np.fromiter((chr(p).isalpha() for p in range(0x110000)), dtype=bool, count=0x110000)
    return np.where(letters, points, 32).astype(np.uint32)


def counts(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets of the text's n-grams and how often each occurs; None without a letter."""
    points = table[np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")]
    if not len(points) or points.max() == 32 and points.min() == 32:
        return None
    space = points == 32
    keep = np.ones(len(points), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1])
    points = points[keep].astype(np.uint64)
    total = np.zeros(BUCKETS, dtype=np.int64)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    for at in range(0, len(points), CHUNK):
        part = points[at:at + CHUNK + max(ORDERS) - 1]
        for order in ORDERS:
            n = min(CHUNK, len(part) - order + 1)
            if n <= 0:
                continue
            code = np.full(n, order, dtype=np.uint64)
            for i in range(order):
                code = (code << np.uint64(20)) + part[i:i + n]
            # One multiplication mixes at most 62 bits; the upper bits are the bucket.
            total += np.bincount((code * MIXER >> shift).astype(np.int64), minlength=BUCKETS)
    found = np.nonzero(total)[0]
    return found, total[found]


def vector(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> np.ndarray:
    """TF-IDF weights of length one, for the buckets in ``found``."""
    values = (1.0 + np.log(found[1])) * idf[found[0]]
    return values / (np.linalg.norm(values) or 1.0)


def _frequencies(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, total, rows = letter_table(), np.zeros(BUCKETS, dtype=np.int64), 0
    for _, texts in text_batches(batches):
        for text in texts:
            if (found := counts(text, table)) is not None:
                total[found[0]] += 1
                rows += 1
    bucket = np.append(np.nonzero(total)[0], -1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(bucket), pa.array(np.append(total[bucket[:-1]], rows))], ["bucket", "n"]
    )


def _vectors(idf: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table()
        for batch, texts in text_batches(batches):
            found = [counts(t, table) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("key"), batch.column("fold"), batch.column("lang"),
                pa.array([None if f is None else f[0].astype("<i4").tobytes() for f in found],
                         pa.binary()),
                pa.array([None if f is None else vector(f, idf).astype("<f4").tobytes()
                          for f in found], pa.binary()),
            ], ["key", "fold", "lang", "buckets", "weights"])

    return run


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def fit_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, width: int,
    alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.01, epochs: int = 3,
) -> np.ndarray:
    """Weights by FTRL-proximal; a row is (columns, values, class)."""
    z, n = np.zeros((classes, width)), np.zeros((classes, width))

    def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((beta + np.sqrt(n)) / alpha + l2)

    for _ in range(epochs):
        for columns, values, label in rows:
            zs, ns = z[:, columns], n[:, columns]
            w = solved(zs, ns)
            error = softmax(w @ values)
            error[label] -= 1.0
            g = error[:, None] * values[None, :]
            z[:, columns] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[:, columns] = ns + g * g
    return solved(z, n)


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by ternary search over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high = np.log(0.02), np.log(20.0)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _columns(row, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The row's vector with the bias as its last entry."""
    return (
        np.append(np.frombuffer(row["buckets"], "<i4"), width),
        np.append(np.frombuffer(row["weights"], "<f4"), 1.0).astype(np.float64),
    )


def train(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = PER_LANGUAGE, rows: int = SAMPLE_ROWS, least: int = LEAST,
    size: int = SAMPLE_BYTES,
) -> Model | None:
    """Fit on documents of the learning folds; None if none has a language and a letter."""
    known = documents.select(
        learning_fold(named(documents, doc_id)).alias("fold"),
        F.xxhash64(named(documents, doc_id), F.lit("sample")).alias("key"),
        named(documents, lang).cast("string").alias("lang"),
        named(documents, text).alias("text"),
    ).filter("fold <> 0 AND lang IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return None
    found = {
        r["bucket"]: r["n"]
        for r in known.select("text").mapInArrow(_frequencies, "bucket long, n long")
        .groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    }
    seen = found.pop(-1, 0)
    frequency = np.zeros(BUCKETS)
    frequency[list(found)] = list(found.values())
    idf = np.log((1 + seen) / (1 + frequency)) + 1.0

    def below(rates: dict[str, float]) -> Column:
        """Of each language the rows whose key's upper 31 bits fall below its rate."""
        limits = F.create_map(*[
            F.lit(x) for name, share in sorted(rates.items()) for x in (name, int(share * 2**31))
        ])
        return F.shiftrightunsigned("key", 33) < limits[F.col("lang")]

    quota = min(per_language, max(least, rows // len(sizes)))
    rates = {name: min(1.0, quota / n) for name, n in sizes.items()}
    vectors = stored(
        known.filter(below(rates)).mapInArrow(
            _vectors(idf), "key long, fold long, lang string, buckets binary, weights binary"
        ).filter("buckets IS NOT NULL"),
        "language-vectors",
    )
    held = {
        r["lang"]: r["held"]
        for r in vectors.groupBy("lang").agg(F.sum(2 * F.octet_length("buckets")).alias("held")).collect()
    }
    shares = {
        name: rates[name] * min(1.0, size / len(held) / n) for name, n in held.items()
    }
    sample = sorted(
        vectors.filter(below(shares)).collect() if held else [],
        key=lambda r: (r["key"], r["lang"], r["buckets"]),
    )
    languages = tuple(sorted({r["lang"] for r in sample}))
    if not languages:
        return None
    number = {name: i for i, name in enumerate(languages)}
    fitted = [(*_columns(r, BUCKETS), number[r["lang"]]) for r in sample
              if r["fold"] != CALIBRATION_FOLD or len(sample) < 50]
    weights = fit_ftrl(fitted, len(languages), BUCKETS + 1)
    left = [r for r in sample if r["fold"] == CALIBRATION_FOLD]
    logits = np.array([weights[:, c] @ v for c, v in (_columns(r, BUCKETS) for r in left)])
    labels = np.array([number[r["lang"]] for r in left], dtype=np.int64)
    temperature = fit_temperature(logits, labels)
    return Model(languages, idf, weights.astype(np.float32), temperature)


def _predictions(model: Model | None, text: str, names: list[str]):
    """A task function that appends the language and the score, under the last two ``names``."""
    languages = model.languages if model else ()
    idf, weights, temperature = (
        (model.idf, model.weights, model.temperature) if model else (None, None, 1.0)
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = letter_table() if languages else None
        for batch, texts in text_batches(batches, text):
            found_names, scores = [], []
            for body in texts:
                found = counts(body, table) if languages else None
                if found is None:
                    found_names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                logits = weights[:, found[0]] @ vector(found, idf) + weights[:, -1]
                p = softmax(logits / temperature)
                found_names.append(languages[int(p.argmax())])
                scores.append(float(p.max()))
            given = dict(zip(batch.schema.names, batch.columns))
            added = [pa.array(found_names, pa.string()), pa.array(scores, pa.float64())]
            kept = [given[n] for n in names[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, *added], names)

    return run


def predict(
    documents: DataFrame, model: Model | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    names = ["doc_id", "held_out", "lang_pred", "score"]
    return documents.select(
        named(documents, doc_id).cast("long").alias("doc_id"),
        (learning_fold(named(documents, doc_id)) == 0).alias("held_out"),
        named(documents, text).alias("text"),
    ).mapInArrow(_predictions(model, "text", names), _SCORED)


def identify(documents: DataFrame) -> DataFrame:
    """Train on the documents' own labels, then predict every document."""
    return predict(documents, train(documents))


def keep_identified(
    documents: DataFrame, least_score: float = 0.4, text: str = "text"
) -> DataFrame:
    """``documents`` without those that are ``und`` or whose language is less sure than that."""
    pred, score = free_names(documents, "lang_pred", "score")
    schema = T.StructType([
        *documents.schema.fields,
        T.StructField(pred, T.StringType()),
        T.StructField(score, T.DoubleType()),
    ])
    step = _predictions(train(documents), text, schema.names)
    scored = documents.mapInArrow(step, schema)
    return scored.filter((F.col(pred) != UNKNOWN) & (F.col(score) >= least_score)).drop(pred, score)
