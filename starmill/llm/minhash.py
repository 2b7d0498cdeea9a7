"""Near-dedup by the similarity of five-word shingles: SimHash and MinHash candidates, exact Jaccard links.

1. A text's set of distinct five-word shingles (hashed to 64 bits; fewer words are one shingle) has
   ``BANDS`` band values of ``ROWS`` minima each. Two sets of similarity s share a band with chance
   1 - (1 - s^5)^24: 0.99993 at 0.8, more above. Texts of one set are one node.
   It also has a SimHash: each of 64 bits is 1 where it is set in over half of the shingles. Nodes within
   two bits are found by ``simhash``'s multi-index hashing and linked first, those of one SimHash to
   the smallest of them. Sets of 0.8 mostly differ by more bits, so the bands decide what is found in the end.
2. Nodes that share a band value meet in a bucket. Every bucket links its members to its smallest
   one, in linear work; after the first bands only one member of each component so far is linked. Pairs stay links only if the Jaccard index of their whole sets is 0.8 or more.
   Sets are made again from the texts of those that are asked for, found by a bitmap over their
   locators, ``SPREAD`` bits for each of them up to ``SLOTS`` in all, so only such rows (and few others,
   which a join drops) are shuffled; a full bitmap costs work, not results.
3. Buckets whose members are still in several components are looked at again: all pairs across
   components where there are at most ``CROWD`` members. In larger ones only pairs across components
   that share one of their rarest shingles are compared: of sets with an index of 0.8 or more, both
   have one of the common shingles among the first fifth of their own, and one of them among its first
   ninth, in any order that all sets use. So every pair that shares a band and belongs together ends up
   in one component.

Components of the links are the groups. Defined results: null texts and texts without a word have the
empty set and are one group. Null ids come last. Repeated rows are one group, of which one row stays.
Very long texts are one set of eight bytes per word, whose minima are taken ``CHUNK`` shingles at a time.
Ties within a group go to the smallest locator. Empty tables give empty results. Extra columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import free_names, named, text_batches
from starmill.llm.exact_dedup import located
from starmill.llm.graph import components, extended
from starmill.llm.simhash import BITS, SEED, keep_least, set_bits
from starmill.llm.simhash import links as simhash_links
from starmill.session import WRITERS, release_finished, stored

SHINGLE = 5
BANDS, ROWS = 24, 5
STARS = ((0, 8), (8, BANDS))
CROWD = 32
CHUNK = 1 << 12
SPREAD, SLOTS = 16, 1 << 27

_RANDOM = np.random.default_rng(SEED)
_WORD_FACTORS = _RANDOM.integers(1 << 62, size=SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RANDOM.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _RANDOM.integers(1 << 62, size=(BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_PRINTS = "doc_id long, file string, row long, fingerprint long, simhash long, n int, bands array<long>"
_SETS = "file string, row long, shingles array<long>"
_KIND = pa.list_(pa.int64())


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.array([xxhash.xxh64_intdigest(w, SEED) for w in words], dtype=np.uint64)
    size = min(SHINGLE, len(words))
    total = np.full(len(words) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        total += _mixed(hashes[i:len(words) - size + 1 + i] * _WORD_FACTORS[i])
    return np.unique(_mixed(total))


def bands(found: np.ndarray) -> np.ndarray:
    """One value per band of the set's minima; none for the empty set."""
    if not len(found):
        return found
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), CHUNK):
        np.minimum(least, (found[None, at:at + CHUNK] * _FACTORS[:, None]).min(axis=1), out=least)
    mixed = _mixed(least).reshape(BANDS, ROWS) * _BAND_FACTORS
    return _mixed(mixed.sum(axis=1, dtype=np.uint64))


def simhash(found: np.ndarray) -> int:
    """The set's SimHash; zero for the empty set."""
    votes = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(found), CHUNK):
        votes += set_bits(found[at:at + CHUNK])
    return int(np.packbits(votes * 2 > len(found), bitorder="little").view("<i8")[0])


def _print_batches(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch, texts in text_batches(batches):
        sets = [shingles(t) for t in texts]
        nodes = [xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets]
        yield pa.RecordBatch.from_arrays([
            *[batch.column(c) for c in ("doc_id", "file", "row")],
            pa.array(np.array(nodes, dtype=np.uint64).view(np.int64)),
            pa.array([simhash(s) for s in sets], pa.int64()),
            pa.array([len(s) for s in sets], pa.int32()),
            pa.array([bands(s).view(np.int64) for s in sets], _KIND),
        ], ["doc_id", "file", "row", "fingerprint", "simhash", "n", "bands"])


def _set_batches(shared: Broadcast):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        bits = shared.value
        for whole in batches:
            slot = whole.column("slot").to_numpy()
            asked = whole.filter(pa.array((bits[slot >> 3] >> (slot & 7) & 1).astype(bool)))
            for batch, texts in text_batches([asked], rows=128):
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(c) for c in ("file", "row")],
                    pa.array([shingles(t).view(np.int64) for t in texts], _KIND),
                ], ["file", "row", "shingles"])

    return run


def _sets(asked: DataFrame, texts: DataFrame) -> DataFrame:
    """``fingerprint, shingles`` of the fingerprints in ``asked``, each with one row's locator."""
    slots = min(max(1 << (SPREAD * asked.count()).bit_length(), 1 << 16), SLOTS)
    slot = F.pmod(F.xxhash64("file", "row"), F.lit(slots)).alias("slot")
    maps = asked.select(slot).groupBy(F.expr("slot div 32768").alias("part")).agg(
        F.bitmap_construct_agg(F.expr("slot % 32768")).alias("bits")
    )
    bits = np.zeros(slots // 8, dtype=np.uint8)
    for r in maps.coalesce(WRITERS * asked.sparkSession.sparkContext.defaultParallelism).collect():
        bits[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], np.uint8)
    shared = asked.sparkSession.sparkContext.broadcast(bits)
    made = texts.select("file", "row", "text", slot).mapInArrow(_set_batches(shared), _SETS)
    return made.join(asked, ["file", "row"]).select("fingerprint", "shingles")


def _sets_of(asked: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``fingerprint, shingles`` of the distinct fingerprints ``asked``, stored."""
    places = nodes.select("fingerprint", "at.file", "at.row").join(asked, "fingerprint", "left_semi")
    return stored(_sets(stored(places, "minhash-asked", narrow=True), texts), "minhash-sets")


def _similar(pairs: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """The stored pairs ``a, b`` of fingerprints whose sets have a Jaccard index of 0.8 or more."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("fingerprint")).distinct()
    sets = _sets_of(asked, nodes, texts)
    side = {
        name: sets.select(F.col("fingerprint").alias(name), F.col("shingles").alias(f"of_{name}"))
        for name in ("a", "b")
    }
    # The side that many pairs share is joined last, when the rows are large enough to be split.
    both = pairs.join(side["b"], "b").join(side["a"], "a")
    common = F.size(F.array_intersect("of_a", "of_b"))
    return stored(
        both.filter(9 * common >= 4 * (F.size("of_a") + F.size("of_b"))).select("a", "b"),
        "minhash-links",
    )


def _crowded_pairs(many: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs across components of the stored rooted members ``many`` that may be similar.

    Members whose buckets hang together are a crowd, and each is held by what sets it apart: the shingles
    in which it differs from those that most of its crowd hold. Two sets differ by as much as their differences
    do, so similar ones either share one of these, or are so close to what is held by most that the closest
    member is similar to both.
    """
    if many.isEmpty():
        return many.selectExpr("fingerprint a", "n an", "fingerprint b", "n bn")
    place = ["band", "key"]
    least = many.groupBy(*place).agg(F.min("fingerprint").alias("a"))
    crowds = components(
        many.join(least, place).select("a", F.col("fingerprint").alias("b")).distinct()
    ).select(F.col("node").alias("fingerprint"), F.col("root").alias("crowd"))
    members = stored(
        many.select("fingerprint", "n", "root").distinct().join(crowds, "fingerprint"), "minhash-members", narrow=True
    )
    held = _sets_of(members.select("fingerprint"), nodes, texts).join(members, "fingerprint")
    shared = (
        held.select("crowd", F.explode("shingles").alias("shingle"))
        .groupBy("crowd", "shingle").agg(F.count("*").alias("often"))
        .join(members.groupBy("crowd").agg(F.count("*").alias("members")), "crowd")
        .filter("2 * often > members")
        .groupBy("crowd").agg(F.collect_list("shingle").alias("most"))
    )
    most = F.coalesce("most", F.array().cast("array<long>"))
    apart = stored(
        held.join(stored(shared, "minhash-most"), "crowd", "left").select(
            "crowd", "fingerprint", "n", "root",
            F.concat(F.array_except("shingles", most), F.array_except(most, "shingles")).alias("apart"),
        ).withColumn("far", 9 * F.size("apart") - F.col("n")),
        "minhash-apart",
    )
    # At 0.8 two sets differ by at most a ninth of both sizes together. If their differences add up to
    # no more, they are similar, and so is each of them to the closest member.
    closest = apart.groupBy("crowd").agg(F.min(F.struct("far", "fingerprint", "n", "root")).alias("by"))
    close = apart.join(closest, "crowd").filter("far + by.far <= 0 AND root <> by.root").select(
        F.col("by.fingerprint").alias("a"), F.col("by.n").alias("an"),
        F.col("fingerprint").alias("b"), F.col("n").alias("bn"),
    )
    each = apart.select("crowd", "fingerprint", F.explode("apart").alias("shingle"))
    often = each.groupBy("crowd", "shingle").agg(F.count("*").alias("often"))
    counted = each.join(often, ["crowd", "shingle"])
    ranked = counted.filter("often > 1").withColumn(
        "place", F.row_number().over(Window.partitionBy("fingerprint").orderBy("often", "shingle"))
    )
    # Shingles that set one member apart only come first in its order, and are in no other's.
    lone = counted.groupBy("fingerprint").agg(F.count_if(F.col("often") == 1).alias("lone"))
    # What comes before the first common one sets the two apart from each other, and so does what one has
    # more than the other after it. One of the two has no more than a ninth of its own size before it.
    earlier = F.col("place") + F.col("lone") - 1
    rare = stored(
        ranked.join(lone, "fingerprint")
        .join(apart.withColumn("all", F.size("apart")).drop("crowd", "apart"), "fingerprint")
        .filter(4 * earlier <= F.col("n"))
        .select(
            "crowd", "shingle", "root", "fingerprint", "n",
            (F.col("n") - 9 * earlier).alias("room"), (F.col("all") - earlier).alias("rest"),
        ),
        "minhash-rare",
    )
    at = ["crowd", "shingle"]
    near = rare.filter("room >= 0")
    roomiest = F.max("room").alias("room")
    across = near.groupBy(*at, "root").agg(roomiest).join(
        rare.groupBy(*at, F.col("root").alias("other")).agg(roomiest.alias("other_room")), at
    ).filter("root <> other AND room + other_room >= 0").select(*at, "root", "other")
    one = near.withColumnsRenamed({"fingerprint": "a", "n": "an", "room": "a_room", "rest": "a_rest"})
    two = rare.withColumnsRenamed(
        {"root": "other", "fingerprint": "b", "n": "bn", "room": "b_room", "rest": "b_rest"}
    )
    return close.union(
        across.join(one, [*at, "root"]).join(two, [*at, "other"])
        .filter("a_room + b_room >= 9 * abs(a_rest - b_rest) AND 5 * least(an, bn) >= 4 * greatest(an, bn)")
        .select("a", "an", "b", "bn")
    )


def _simhash_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs within two bits: the smallest nodes of linked SimHashes, and each node with its smallest."""
    centres = stored(
        nodes.groupBy("simhash").agg(F.min(F.struct("fingerprint", "n")).alias("centre")),
        "minhash-simhash", narrow=True,
    )
    linked = simhash_links(centres.select(F.col("simhash").alias("fingerprint"))).distinct()
    side = {
        name: centres.select(
            F.col("simhash").alias(name), F.col("centre.fingerprint").alias(f"{name}_node"),
            F.col("centre.n").alias(f"{name}n"),
        )
        for name in ("a", "b")
    }
    across = linked.join(side["a"], "a").join(side["b"], "b").select("a_node", "an", "b_node", "bn")
    return nodes.join(centres, "simhash").select(
        F.col("centre.fingerprint").alias("a"), F.col("centre.n").alias("an"),
        F.col("fingerprint").alias("b"), F.col("n").alias("bn"),
    ).union(across)


def links(prints: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of fingerprints of the stored prints that connect all similar ones.

    ``texts`` has ``text`` of the prints' rows by ``file`` and ``row``.
    """
    near, _, last = _searched(prints, texts)
    return near.union(last)


def _searched(prints: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The links but for the last ones, their components as ``node, root``, and the last links."""
    # Rows of one fingerprint have the same bands, SimHash and size.
    nodes = stored(prints.groupBy("fingerprint").agg(
        F.min(F.struct("file", "row")).alias("at"), F.first("bands").alias("bands"),
        F.first("n").alias("n"), F.first("simhash").alias("simhash"),
    ), "minhash-nodes")
    placed = nodes.select(F.posexplode("bands").alias("band", "key"), "fingerprint", "n")
    place = ["band", "key"]
    several = placed.groupBy(*place).agg(F.count("*").alias("members")).filter("members > 1")
    shared = stored(placed.join(several.drop("members"), place), "minhash-shared", narrow=True)

    def rooted(members: DataFrame) -> DataFrame:
        """The members with the root of their component so far."""
        of = roots.withColumnRenamed("node", "fingerprint")
        return members.join(of, "fingerprint", "left").withColumn(
            "root", F.coalesce("root", "fingerprint")
        )

    def asked(pairs: DataFrame) -> DataFrame:
        """Sets of too different sizes cannot be similar."""
        return pairs.filter("a <> b AND 5 * least(an, bn) >= 4 * greatest(an, bn)").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        ).distinct().join(tried, ["a", "b"], "left_anti")

    tried = nodes.selectExpr("fingerprint a", "fingerprint b").filter("false")
    pairs = stored(asked(_simhash_pairs(nodes)), "minhash-simhash-pairs", narrow=True)
    near, tried = _similar(pairs, nodes, texts), pairs
    roots = components(near)
    release_finished(prints.sparkSession)

    for first, end in STARS:
        # One member of each component stands for it, so a large group costs a few bands only.
        standing = stored(
            rooted(shared.filter((F.col("band") >= first) & (F.col("band") < end)))
            .groupBy(*place, "root").agg(F.min(F.struct("fingerprint", "n")).alias("member")),
            "minhash-standing", narrow=True,
        )
        centres = standing.groupBy(*place).agg(
            F.min("member").alias("centre"), F.count("*").alias("members")
        ).filter("members > 1").drop("members")
        starred = standing.join(centres, place).select(
            F.col("centre.fingerprint").alias("a"), F.col("centre.n").alias("an"),
            F.col("member.fingerprint").alias("b"), F.col("member.n").alias("bn"),
        )
        pairs = stored(asked(starred), "minhash-starred", narrow=True)
        found = _similar(pairs, nodes, texts)
        tried = tried.union(pairs)
        near = near.union(found)
        roots = extended(roots, found)
        release_finished(prints.sparkSession)

    rooted_members = stored(rooted(shared), "minhash-rooted", narrow=True)
    unsettled = stored(
        rooted_members.groupBy(*place).agg(
            F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("members")
        ).filter("least <> most").select(*place, "members"),
        "minhash-unsettled", narrow=True,
    )
    few = rooted_members.join(unsettled.filter(F.col("members") <= CROWD), place).drop("members")
    many = stored(
        rooted_members.join(unsettled.filter(F.col("members") > CROWD), place).drop("members"),
        "minhash-crowded", narrow=True,
    )
    other = few.select(
        *place, F.col("fingerprint").alias("a"), F.col("n").alias("an"), F.col("root").alias("a_root")
    )
    pairs = few.withColumnsRenamed({"fingerprint": "b", "n": "bn"}).join(other, place).filter(
        "a < b AND a_root <> root"
    ).select("a", "an", "b", "bn")
    crowded = _crowded_pairs(many, nodes, texts)
    pairs = stored(asked(pairs.union(crowded)), "minhash-pairs")
    release_finished(prints.sparkSession)
    return near, roots, _similar(pairs, nodes, texts)


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with one row of each group: that of the smallest id, then locator."""
    file, row = free_names(documents, "minhash_file", "minhash_row")
    source = located(documents, file, row)
    rows = source.select(
        named(source, doc_id).cast("long").alias("doc_id"),
        named(source, file).alias("file"),
        named(source, row).alias("row"),
        named(source, text).alias("text"),
    )
    prints = stored(rows.mapInArrow(_print_batches, _PRINTS), "minhash-prints")
    _, roots, last = _searched(prints, rows)
    roots = extended(roots, last)
    release_finished(prints.sparkSession)
    return keep_least(documents, source, prints, roots, file, row)
