"""SimHash near-dedup by multi-index hashing.

A fingerprint has 64 bits, indexed as two segments of 32. Fingerprints within 2 bits differ by at
most 1 bit in the upper segment, or else not at all in the lower one. So the table holds each
distinct fingerprint under both segments; a probe enumerates the Hamming ball of radius 1 of its
upper segment and radius 0 of its lower one; matches are verified over all 64 bits. Of the ball only
members with a bit cleared are enumerated, because the partner with that bit set finds the pair.

Crowded segment values (more than ``CROWD`` fingerprints, as in a large group of near copies) would
make matches grow with the square. Fingerprints that meet there enumerate the radius-1 ball of each
segment with the other segment kept, 65 keys of 64 bits: two fingerprints share such a key exactly
when they differ by at most 2 bits. Each key holds at most 65 fingerprints and links them to its
smallest one, so no link is lost and the work is linear.

Copies share a fingerprint and are one node; nothing expands them into pairs.

Defined results: null and empty texts, and texts without a word, have fingerprint zero and are linked
like any other. Null ids are ignored in ``component_id`` (null when a component has no other). Repeated
rows give repeated results. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import free_names, named, text_batches
from starmill.llm.exact_dedup import located
from starmill.llm.graph import components
from starmill.session import stored

SHINGLE = 3
SEED = 42
BITS = 64
DISTANCE = 2
CROWD = 16
CHUNK = 1 << 16

_FINGERPRINTS = "doc_id long, file string, row long, fingerprint long"


def set_bits(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str) -> int:
    """Each bit is 1 where it is set in over half of the shingles' hashes."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    joined, size = b" ".join(words), min(SHINGLE, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = len(words) - size + 1
    starts, ends = starts[:total].tolist(), ends[size - 1:].tolist()
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, total, CHUNK):
        hashes = np.array([
            xxhash.xxh64_intdigest(joined[a:b], SEED)
            for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK])
        ], dtype="<u8")
        votes += set_bits(hashes)
    return int(np.packbits(votes * 2 > total, bitorder="little").view("<i8")[0])


def _fingerprint_batches(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        found = pa.array([fingerprint(t) for t in texts], pa.int64())
        kept = [batch.column(c) for c in ("doc_id", "file", "row")]
        yield pa.RecordBatch.from_arrays([*kept, found], ["doc_id", "file", "row", "fingerprint"])


def _prints(rows: DataFrame, doc_id: str, text: str, file: str, row: str) -> DataFrame:
    return rows.select(
        named(rows, doc_id).cast("long").alias("doc_id"),
        named(rows, file).alias("file"),
        named(rows, row).alias("row"),
        named(rows, text).alias("text"),
    ).mapInArrow(_fingerprint_batches, _FINGERPRINTS)


def fingerprints(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, the row's locator, and the fingerprint as a signed 64-bit number."""
    file, row = free_names(documents, "file", "row")
    return _prints(located(documents, file, row), doc_id, text, file, row)


def links(nodes: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of the distinct ``fingerprint`` values that connect all pairs in distance."""
    upper, lower = "shiftrightunsigned(fingerprint, 32)", "fingerprint & 4294967295L"
    table = nodes.selectExpr(
        "fingerprint", f"inline(array(struct(0 AS part, {upper} AS key),"
                       f" struct(1 AS part, {lower} AS key)))"
    )
    cleared = nodes.selectExpr("fingerprint", f"{upper} AS half").selectExpr(
        "fingerprint", "0 AS part",
        "explode(transform(filter(sequence(0, 31), b -> getbit(half, b) = 1),"
        " b -> half - shiftleft(1L, b))) AS key",
    )
    place = ["part", "key"]
    crowded = stored(
        table.groupBy(*place).count().filter(F.col("count") > CROWD).select(*place),
        "simhash-crowded", narrow=True,
    )

    def matches(probes: DataFrame, same: bool) -> DataFrame:
        held = table.join(crowded, place, "left_anti").withColumnRenamed("fingerprint", "b")
        asked = probes.join(crowded, place, "left_anti").withColumnRenamed("fingerprint", "a")
        pairs = asked.join(held, place)
        return (pairs.filter("a < b") if same else pairs).select("a", "b")

    crowd = (
        table.join(crowded, place, "left_semi")
        .union(cleared.select(*table.columns).join(crowded, place, "left_semi"))
        .select("fingerprint").distinct()
    )
    balls = stored(crowd.selectExpr(
        "fingerprint",
        "explode(concat(array(fingerprint), transform(sequence(0, 63),"
        " b -> fingerprint ^ shiftleft(1L, b)))) AS key",
    ), "simhash-balls")
    centres = balls.groupBy("key").agg(F.min("fingerprint").alias("a"))
    starred = balls.withColumnRenamed("fingerprint", "b").join(centres, "key").select("a", "b")
    return (
        matches(table, True).union(matches(cleared, False)).union(starred)
        .filter(f"a <> b AND bit_count(a ^ b) <= {DISTANCE}")
    )


def group_nodes(prints: DataFrame, least: Column, roots: DataFrame | None = None) -> DataFrame:
    """``fingerprint`` of each node of the stored prints, and ``least`` over its component.

    ``roots`` has ``node, root`` of fingerprints; by default the components of those in distance.

    Rows are reduced to one per distinct fingerprint before anything is joined, so a component of
    very many copies is no larger here than one of few.
    """
    nodes = stored(prints.groupBy("fingerprint").agg(least.alias("least")), "simhash-nodes", narrow=True)
    roots = components(links(nodes.select("fingerprint"))) if roots is None else roots
    rooted = stored(
        nodes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
            "root", F.coalesce("root", "fingerprint")
        ),
        "simhash-roots", narrow=True,
    )
    whole = stored(
        rooted.groupBy("root").agg(F.min("least").alias("least")), "simhash-components", narrow=True
    )
    return stored(
        rooted.drop("least").join(whole, "root").select("fingerprint", "least"), "simhash-least", narrow=True
    )


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, fingerprint as 16 hex digits, component_id: the smallest id that links reach."""
    prints = stored(fingerprints(documents, doc_id, text), "simhash-prints")
    return prints.join(group_nodes(prints, F.min("doc_id")), "fingerprint").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("least").alias("component_id"),
    )


def keep_least(
    documents: DataFrame, source: DataFrame, prints: DataFrame, roots: DataFrame | None,
    file: str, row: str,
) -> DataFrame:
    """The columns of ``documents`` from ``source`` with the first row of each component only."""
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "file", "row")
    # The rows that go are few where those that stay are many, so they are the side that is joined.
    dropped = prints.select("doc_id", "file", "row", "fingerprint").join(
        group_nodes(prints, F.min(order), roots), "fingerprint"
    ).filter(
        F.struct("file", "row") != F.struct("least.file", "least.row")
    ).select(F.col("file").alias(file), F.col("row").alias(row))
    result = source.join(stored(dropped, "simhash-dropped", narrow=True), [file, row], "left_anti")
    return result.select(*[named(result, c) for c in documents.columns])


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with one row of each component: that of the smallest id, then locator."""
    file, row = free_names(documents, "simhash_file", "simhash_row")
    source = located(documents, file, row)
    prints = stored(_prints(source, doc_id, text, file, row), "simhash-prints")
    return keep_least(documents, source, prints, None, file, row)
