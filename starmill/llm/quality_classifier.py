"""Quality scores: ridge regression on random Fourier features of document statistics.

1. One narrow map turns every whole text into ``STATISTICS`` numbers; the table of statistics lies in
   the shared folder and everything else reads only that.
2. Labels join the statistics. Means and deviations standardise them; random Fourier features
   ``sqrt(2/D) cos(W x + b)`` then approximate a Gaussian kernel.
3. Each task sums its share of the normal equations; Spark adds the sums up per matrix entry, so the
   driver receives one matrix of fixed size, from all labelled rows.
4. Scores of the labelled learning rows are counted per bin; pool-adjacent-violators over the bins
   gives the calibration, a rising step function with straight lines between its steps.

Labels: one per document; if a document has several, their mean is used. Null labels are left out.
Only documents of the learning folds teach. Defined results: null and empty texts have statistics
zero and are scored like others. Null ids are held out, and never match a label. With no label to
learn from every score is 0.5. Repeated rows give repeated results; in learning, a repeated document
counts as often as it occurs. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import learning_fold, named, text_batches
from starmill.session import stored

FEATURES = 192
SEED = 20
RIDGE = 1e-3
BINS = 2000
THRESHOLD = 0.3
KERNEL_WIDTH = 4.0
CHUNK = 1 << 20

STATISTICS = (
    "log_chars", "log_words", "word_length", "capitals", "digits", "punctuation", "symbols", "pipes",
    "marks", "others", "distinct_words", "top_word", "log_lines", "line_length", "distinct_lines",
    "repeated_bigrams", "short_words", "ends", "commas", "entropy", "capital_lines", "symbol_lines",
)
_SCORED = "doc_id long, held_out boolean, score double, predicted int"


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    deviation: np.ndarray
    turns: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # raw scores, rising
    values: np.ndarray  # calibrated scores at these


def character_classes() -> np.ndarray:
    """Byte classes: 0 other, 1 capital, 2 digit, 3 space, 4 punctuation, 5 symbol, 6 pipe, 7 mark,
    8 small letter, 9 part of a longer character."""
    kind = np.zeros(256, dtype=np.uint8)
    for number, members in (
        (1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"0123456789"), (3, b" \t\n\r\x0b\x0c"),
        (4, b".,;:-'\"()"), (5, b"#*$%&<>@=+/\\_^~`{}[]"), (6, b"|"), (7, b"!?"),
        (8, b"abcdefghijklmnopqrstuvwxyz"),
    ):
        kind[list(members)] = number
    kind[128:] = 9
    return kind


def statistics(text: str, kind: np.ndarray) -> list[float]:
    """The numbers named in ``STATISTICS`` for one whole text."""
    raw = text.encode()
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    if not words:
        return [0.0] * len(STATISTICS)
    of_kind = np.zeros(10, dtype=np.int64)
    for at in range(0, len(raw), CHUNK):
        part = np.frombuffer(raw, np.uint8, count=min(CHUNK, len(raw) - at), offset=at)
        of_kind += np.bincount(kind[part], minlength=10)
    solid = len(raw) - of_kind[3]
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    count = np.fromiter(tally.values(), np.int64, len(tally))
    share = count / len(words)
    bigrams = len(set(zip(words, words[1:])))
    letters = of_kind[1] + of_kind[8]

    def heavy(line: bytes, members: bytes) -> bool:
        return 8 * (len(line) - len(line.translate(None, members))) > len(line)

    return [
        np.log1p(len(raw)), np.log1p(len(words)), solid / len(words),
        of_kind[1] / max(letters, 1), of_kind[2] / solid, of_kind[4] / solid, of_kind[5] / solid,
        of_kind[6] / solid, of_kind[7] / solid, of_kind[9] / solid,
        len(tally) / len(words) ** 0.8, share.max(), np.log1p(len(lines)),
        np.log1p(len(raw) / max(len(lines), 1)), len(set(lines)) / max(len(lines), 1),
        1.0 - bigrams / max(len(words) - 1, 1),
        sum(len(w) <= 3 for w in words) / len(words), raw.count(b".") / len(words),
        raw.count(b",") / len(words), float(-(share * np.log(share)).sum()) / np.log(len(words) + 1),
        sum(line.isupper() for line in lines) / max(len(lines), 1),
        sum(heavy(line, b"#*$%&|<>") for line in lines) / max(len(lines), 1),
    ]


def _statistics(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = character_classes()
    for batch, texts in text_batches(batches):
        values = np.array([statistics(t, kind) for t in texts], dtype=np.float32)
        values = values.reshape(len(texts), len(STATISTICS))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("fold"),
             pa.array([v.tobytes() for v in values], pa.binary())],
            ["doc_id", "fold", "statistics"],
        )


def measured(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored ``doc_id, fold, statistics`` of every document."""
    rows = documents.select(
        named(documents, doc_id).cast("long").alias("doc_id"),
        learning_fold(named(documents, doc_id)).alias("fold"),
        named(documents, text).alias("text"),
    )
    return stored(
        rows.mapInArrow(_statistics, "doc_id long, fold long, statistics binary"), "quality-statistics"
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    raw = b"".join(batch.column("statistics").to_pylist())
    return np.frombuffer(raw, np.float32).reshape(-1, len(STATISTICS)).astype(np.float64)


def _entries(values: np.ndarray) -> pa.RecordBatch:
    flat = values.ravel()
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(flat))), pa.array(flat)], ["entry", "value"]
    )


def _added(parts: DataFrame, shape: tuple[int, ...]) -> np.ndarray | None:
    """Per-task sums added up entry by entry; None if there were no rows."""
    summed = parts.groupBy("entry").agg(F.sum("value").alias("value"))
    found = {r["entry"]: r["value"] for r in summed.collect()}
    if not found:
        return None
    return np.array([found[i] for i in range(len(found))]).reshape(shape)


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, width = None, len(STATISTICS)
    for batch in batches:
        if not batch.num_rows:
            continue
        x = _matrix(batch)
        part = np.stack([np.full(width, float(len(x))), x.sum(axis=0), (x * x).sum(axis=0)])
        total = part if total is None else total + part
    if total is not None:
        yield _entries(total)


def fourier(x: np.ndarray, model: Model) -> np.ndarray:
    """Random Fourier features and a constant."""
    turned = ((x - model.mean) / model.deviation) @ model.turns + model.phases
    return np.hstack([np.sqrt(2.0 / FEATURES) * np.cos(turned), np.ones((len(x), 1))])


def _normal_equations(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            z = fourier(_matrix(batch), model)
            y = batch.column("label").to_numpy(zero_copy_only=False)
            part = z.T @ np.hstack([z, y[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield _entries(total)

    return run


def _bins(raw: np.ndarray) -> np.ndarray:
    """Raw scores from -1 to 2 in steps of equal width."""
    return np.clip(((raw + 1.0) / 3.0 * BINS).astype(np.int64), 0, BINS - 1)


def _binned(model: Model):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, BINS))
        for batch in batches:
            if batch.num_rows:
                place = _bins(fourier(_matrix(batch), model) @ model.weights)
                y = batch.column("label").to_numpy(zero_copy_only=False)
                total[0] += np.bincount(place, minlength=BINS)
                total[1] += np.bincount(place, weights=y, minlength=BINS)
        yield _entries(total)

    return run


def isotonic(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Rising means of weighted points, by pooling neighbours that fall."""
    blocks: list[list[float]] = []
    for n, s in zip(count, total):
        blocks.append([s, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s2, n2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s2, blocks[-1][1] + n2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), s / n) for s, n, k in blocks])


def train(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model | None:
    """Fit on the stored statistics of the learning folds that have a label."""
    marks = labels.select(
        named(labels, "doc_id").cast("long").alias("doc_id"),
        named(labels, label).cast("double").alias("label"),
    ).filter("doc_id IS NOT NULL AND label IS NOT NULL")
    marks = marks.groupBy("doc_id").agg(F.avg("label").alias("label"))
    learned = stored(rows.filter("fold <> 0").join(marks, "doc_id"), "quality-learned")
    width = len(STATISTICS)
    entry = "entry long, value double"
    moments = _added(learned.select("statistics").mapInArrow(_moments, entry), (3, width))
    if moments is None:
        return None
    mean = moments[1] / moments[0]
    spread = np.sqrt(np.maximum(moments[2] / moments[0] - mean**2, 0.0))
    random = np.random.default_rng(SEED)
    model = Model(
        mean, np.where(spread > 1e-9, spread, 1.0),
        random.normal(size=(width, FEATURES)) / KERNEL_WIDTH,
        random.uniform(0.0, 2.0 * np.pi, FEATURES), np.zeros(FEATURES + 1), np.zeros(0), np.zeros(0),
    )
    pairs = learned.select("statistics", "label")
    sums = _added(
        pairs.mapInArrow(_normal_equations(model), entry), (FEATURES + 1, FEATURES + 2)
    )
    gram, right = sums[:, :-1], sums[:, -1]
    model = _with(model, weights=np.linalg.solve(
        gram + RIDGE * moments[0, 0] * np.diag([1.0] * FEATURES + [0.0]) / FEATURES
        + 1e-9 * np.eye(FEATURES + 1), right
    ))
    count, total = _added(pairs.mapInArrow(_binned(model), entry), (2, BINS))
    used = count > 0
    middles = (np.arange(BINS) + 0.5) / BINS * 3.0 - 1.0
    return _with(model, steps=middles[used], values=isotonic(count[used], total[used]))


def _with(model: Model, **changes) -> Model:
    return Model(**{**vars(model), **changes})


def _scores(model: Model | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = np.full(batch.num_rows, 0.5)
            if model is not None:
                raw = fourier(_matrix(batch), model) @ model.weights
                score = np.clip(np.interp(raw, model.steps, model.values), 0.0, 1.0)
            held = np.equal(batch.column("fold").to_numpy(zero_copy_only=False), 0)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(held), pa.array(score),
                pa.array((score >= THRESHOLD).astype(np.int32)),
            ], ["doc_id", "held_out", "score", "predicted"])

    return run


def score_quality(documents: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """doc_id, held_out, score and predicted for every document."""
    rows = measured(documents)
    return rows.mapInArrow(_scores(train(rows, labels, label)), _SCORED)
