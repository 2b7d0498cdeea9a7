"""Packing: deficit round-robin over source queues into windows of a fixed number of tokens.

Each source is a queue of its documents' tokens, cut into quanta. In every round a queue earns credit
in proportion to its target; a quantum is served when its queue's credit reaches the middle of it, and
what is over or short (the deficit, below one quantum) carries on to the next round, window and
partition. Served in this order, quanta fill windows without gaps. The order has a closed form: the
quanta of queue t served before quantum c of queue s are those with (2c' + 1) / w_t below
(2c + 1) / w_s, so any task computes the place of any token from the queues' totals and its own
document's place in its queue, and no task waits for another.

1. Documents are encoded once. The table of ids, in the shared folder, also holds each document's
   token offset within its task (block) and queue.
2. Tokens per block and queue are summed; running sums over blocks give each block's offset.
3. Each document's ids are read back and cut at quanta and windows; checksums are taken there.

The last tokens that do not fill a window go to windows of falling powers of two, which need no
padding. Nothing is dropped, and a hot source is one queue spread over all tasks.

Defined results: null and empty texts have the end id alone. A null source is a queue of its own.
Null ids and repeated rows are packed like others. Empty tables give empty results. Sources beyond
the ``MAX_QUEUES - 1`` with most rows share the last queue. Extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import named, text_batches
from starmill.session import scratch_dir

WINDOW = 2048
QUANTUM = 256
END_ID = 1
MAX_QUEUES = 256
SCALE = 1 << 20

# The pre-tokenisation pattern of the byte-level vocabulary.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_ENCODED = "block int, queue int, doc_id long, before long, doc_tokens long, ids binary"
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
    " offset long"
)


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def load_vocabulary(path: str) -> tuple[dict[bytes, int], dict[str, int]]:
    """Byte strings with their ids, and the special tokens, of a tokenizer's JSON file."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    letters = byte_letters()
    ranks = {
        bytes(letters[c] for c in token): rank
        for token, rank in model["model"]["vocab"].items() if token not in special
    }
    return ranks, special


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to ids. A text the fast library refuses goes to the library that defines the ids."""
    import tiktoken

    ranks, special = load_vocabulary(path)
    fast = tiktoken.Encoding(
        "packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
    )
    slow = []

    def encode(text: str) -> np.ndarray:
        try:
            return fast.encode_to_numpy(text, allowed_special="all")
        except BaseException as error:  # a panic in native code is no Exception
            if isinstance(error, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            if not slow:
                from tokenizers import Tokenizer

                slow.append(Tokenizer.from_file(path))
            return np.array(slow[0].encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    return encode


def _encode_batches(path: str, queues: dict[str | None, int], last: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, block, totals = encoder(path), TaskContext.get().partitionId(), {}
        for batch, texts in text_batches(batches, rows=256):
            sources = batch.column("source").to_pylist()
            queue, before, sizes, ids = [], [], [], []
            for text, source in zip(texts, sources):
                found = np.append(encode(text), END_ID).astype("<u4")
                q = queues.get(source, last)
                queue.append(q)
                before.append(totals.get(q, 0))
                sizes.append(len(found))
                totals[q] = before[-1] + len(found)
                ids.append((found.astype("<u2") if found.max() < 1 << 16 else found).tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * len(ids), pa.int32()), pa.array(queue, pa.int32()),
                batch.column("doc_id"), pa.array(before, pa.int64()),
                pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()),
            ], ["block", "queue", "doc_id", "before", "doc_tokens", "ids"])

    return run


def tokens_before(
    queue: np.ndarray, quantum: np.ndarray, totals: np.ndarray, weights: np.ndarray, size: int
) -> np.ndarray:
    """Tokens of all queues that are served before each (queue, quantum)."""
    found = quantum * size  # the queue's own
    odd = 2 * quantum + 1
    for other in range(len(totals)):
        reach = odd * weights[other]
        # Odd numbers m with m / weights[other] below odd / weights[queue]; ties by queue number.
        most = (reach - (queue <= other)) // weights[queue]
        served = np.minimum(totals[other], size * ((most + 1) // 2))
        found += np.where(queue == other, 0, served)
    return found


def tail_starts(total: int, window: int) -> list[int]:
    """Where the windows after the full ones begin, and the end: falling powers of two."""
    at, cuts = total - total % window, []
    size = window
    while at < total:
        size >>= 1
        if total - at >= size:
            cuts.append(at)
            at += size
    return [*cuts, total]


def cut(place: np.ndarray, length: np.ndarray, bounds: Callable[[np.ndarray], np.ndarray]):
    """Cut spans at bounds(position) = end of the window there; yields (span, from, size)."""
    span, start = np.arange(len(place)), np.zeros(len(place), dtype=np.int64)
    while len(span):
        size = np.minimum(bounds(place + start), place + length) - place - start
        yield span, start, size
        start = start + size
        more = start < length
        span, start, place, length = span[more], start[more], place[more], length[more]


def _piece_batches(totals: list[int], weights: list[int], window: int, quantum: int):
    total_of, weight_of = np.array(totals, dtype=np.int64), np.array(weights, dtype=np.int64)
    tail = np.array(tail_starts(sum(totals), window), dtype=np.int64)
    full = int(tail[0])

    def ends(place: np.ndarray) -> np.ndarray:
        inside = (place // window + 1) * window
        return np.where(
            place < full, inside, tail[np.searchsorted(tail[:-1], place, "right")]
        ) if len(tail) > 1 else inside

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queue, first, size = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in ("queue", "first", "doc_tokens")
            )
            if not len(queue):
                continue
            # Quanta that each document touches.
            low, high = first // quantum, (first + size - 1) // quantum
            count = high - low + 1
            doc = np.repeat(np.arange(len(queue)), count)
            number = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + low[doc]
            start = np.maximum(number * quantum - first[doc], 0)
            stop = np.minimum((number + 1) * quantum - first[doc], size[doc])
            place = tokens_before(queue[doc].astype(np.int64), number, total_of, weight_of, quantum)
            place += first[doc] + start - number * quantum
            parts = [
                (doc[s], start[s] + a, n, place[s] + a) for s, a, n in cut(place, stop - start, ends)
            ]
            doc, start, length, place = (np.concatenate(x) for x in zip(*parts))
            in_tail = np.searchsorted(tail[:-1], place, "right") - 1
            late = place >= full
            sequence = np.where(late, full // window + in_tail, place // window)
            begin = np.where(late, tail[np.maximum(in_tail, 0)], place // window * window)
            sums, held = np.zeros(len(doc), dtype=np.int64), batch.column("ids")
            order = np.argsort(doc, kind="stable")
            at, ids = -1, memoryview(b"")
            for i, a, n in zip(order.tolist(), start[order].tolist(), length[order].tolist()):
                if doc[i] != at:
                    at = doc[i]
                    raw = held[int(at)].as_py()
                    kind = "<u2" if len(raw) == 2 * size[at] else "<u4"
                    ids = memoryview(np.frombuffer(raw, kind).astype("<u4")).cast("B")
                sums[i] = zlib.crc32(ids[4 * a:4 * (a + n)])
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length),
                pa.array(sums), pa.array(size[doc]), pa.array(sequence), pa.array(place - begin),
            ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return run


def pack(
    documents: DataFrame,
    tokenizer: str,
    targets: Mapping[str, float] | None = None,
    window: int = WINDOW,
    quantum: int = QUANTUM,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row per piece of a document in a window.

    ``targets`` are relative token shares by source; by default each source's share of all tokens,
    with which every queue lasts to the end. ``window`` is a power of two.
    """
    spark = documents.sparkSession
    rows = documents.select(
        named(documents, doc_id).cast("long").alias("doc_id"),
        named(documents, text).alias("text"),
        named(documents, source).cast("string").alias("source"),
    )
    largest = rows.groupBy("source").count().orderBy(F.desc("count"), "source")
    names = [r["source"] for r in largest.limit(MAX_QUEUES - 1).collect()]
    path = scratch_dir(spark, "packing-ids")
    rows.mapInArrow(
        _encode_batches(tokenizer, {n: i for i, n in enumerate(names)}, len(names)), _ENCODED
    ).write.parquet(path)
    encoded = spark.read.schema(_ENCODED).parquet(path)

    blocks = encoded.groupBy("block", "queue").agg(F.sum("doc_tokens").alias("tokens"))
    sums = scratch_dir(spark, "packing-blocks")
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    blocks.select(
        "block", "queue", "tokens", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("base")
    ).write.parquet(sums)
    offsets = spark.read.schema("block int, queue int, tokens long, base long").parquet(sums)
    totals = [0] * (len(names) + 1)
    for r in offsets.groupBy("queue").agg(F.sum("tokens").alias("n")).collect():
        totals[r["queue"]] = r["n"]
    shares = [
        float(n if targets is None else targets.get(name, 0) or 0)
        for n, name in zip(totals, [*names, None])
    ]
    most = max(shares) or 1.0
    weights = [max(1, round(SCALE * s / most)) for s in shares]
    return (
        encoded.join(offsets.drop("tokens"), ["block", "queue"])
        .select("doc_id", "queue", "doc_tokens", (F.col("base") + F.col("before")).alias("first"), "ids")
        .mapInArrow(_piece_batches(totals, weights, window, quantum), _PIECES)
    )
