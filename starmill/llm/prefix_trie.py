"""Prefix trie of conversations by fixed-length block hashing.

1. Rebuilding. Every conversation c starts with the first turns of conversation ``c - c % 5`` (how
   many, its own number's hash says), followed by what is left of its own. At most ``FRONT`` turns are
   borrowed, so a long conversation is not copied.
2. Digests. A turn's digest is 128 bits of SHA-256 over its position, role and text, in four limbs;
   digests add up limb by limb. A prefix's key is the sum over its turns, so blocks and ranges of turns
   are summed apart and then put together.
3. Blocks. Conversations are grouped by their prefixes of whole blocks of ``BLOCK`` turns. A block that
   all members of the prefix before it share is a chain: its turns are nodes of the same members, read
   from one of them. Only turns of the other blocks, where siblings diverge or members end, are
   grouped one by one.
4. Subtrees. The nodes of one smallest member are a chain, and chains form a tree of conversations.
   Its totals come by pointer doubling, in rounds that grow with the logarithm of its height; within
   a chain, sums from the end come by running sums over ranges.

Turns of equal position in time are ordered by role, then by the SHA-256 of their text. Defined results:
null roles and texts are empty; null turns come first; rows without ``conv_id`` belong to no
conversation and are left out. Repeated rows are turns of their own. Very long texts only pass through
hash functions. Without any conversation there is no node. Extra columns are ignored, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import free_names, named, ordered_sha256
from starmill.llm.exact_dedup import located
from starmill.operators.scans import running
from starmill.session import stored

BLOCK = 4
FRONT = 8
FAMILY = 5
IDS = 1024
LIMBS = ("k0", "k1", "k2", "k3")


def _placed(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, role, content, bytes`` of every turn, in its conversation's order."""
    file, row = free_names(turns, "trie_file", "trie_row")
    source = located(turns, file, row)
    role, text = [F.coalesce(named(source, c), F.lit("")) for c in ("role", "text")]
    narrow = source.select(
        named(source, "conv_id").cast("long").alias("conv_id"),
        named(source, "turn").alias("turn"),
        role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("content"),
        F.octet_length(text).cast("long").alias("bytes"),
        named(source, file).alias("file"),
        named(source, row).alias("row"),
    ).filter("conv_id IS NOT NULL")
    order = ["turn", "role", "content", "file", "row"]
    return stored(
        running(narrow, ["conv_id"], order, {"pos": F.lit(1)}).drop("turn", "file", "row"), "trie-placed"
    )


def _digest() -> list[Column]:
    """The limbs of a turn at its position; roles are told from texts by their length."""
    whole = F.sha2(F.concat_ws(":", "pos", F.length("role"), "role", F.hex("content")), 256)
    return [
        F.conv(F.substring(whole, 8 * i + 1, 8), 16, 10).cast("long").alias(k)
        for i, k in enumerate(LIMBS)
    ]


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rebuilt turns ``conv_id, pos, bytes`` with their limbs, and all ``conv_id`` with ``size``."""
    placed = _placed(turns)
    asked = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (FRONT + 1)
    sizes = placed.groupBy("conv_id").agg(F.max("pos").alias("own"))
    given = sizes.filter(f"conv_id % {FAMILY} = 0").select(
        F.col("conv_id").alias("base"), F.col("own").alias("there")
    )
    convs = stored(
        sizes.withColumns({"base": F.expr(f"conv_id - conv_id % {FAMILY}"), "asked": asked})
        .join(given, "base", "left")
        .withColumn("taken", F.least("asked", F.coalesce("there", F.lit(0))))
        .select(
            "conv_id", "base", "asked", "taken",
            (F.col("taken") + F.greatest(F.col("own") - F.col("asked"), F.lit(0))).alias("size"),
        ),
        "trie-conversations",
    )
    kept = ["pos", "role", "content", "bytes"]
    heads = placed.filter(f"pos <= {FRONT} AND conv_id % {FAMILY} = 0").select(
        F.col("conv_id").alias("base"), *kept
    )
    front = convs.join(heads, "base").filter("pos <= taken").select("conv_id", *kept)
    own = placed.join(convs, "conv_id").filter("pos > asked").select(
        "conv_id", (F.col("pos") - F.col("asked") + F.col("taken")).alias("pos"), *kept[1:]
    )
    rebuilt = front.union(own).select("conv_id", "pos", "bytes", *_digest())
    return stored(rebuilt, "trie-rebuilt"), convs.select("conv_id", "size")


def _key(limbs: list[Column]) -> Column:
    return F.concat_ws(",", *limbs)


ROOT = ",".join("0" for _ in LIMBS)


def _block_rows(rebuilt: DataFrame, all_convs: int) -> DataFrame:
    """``conv_id, block``, the limbs ``before`` the block, and whether the block is a chain.

    Of a chain only the smallest member is left, with the number of all; other blocks, whole or not,
    are there for every conversation.
    """
    block = F.expr(f"(pos - 1) div {BLOCK}").alias("block")
    sums = rebuilt.groupBy("conv_id", block).agg(
        F.count("*").alias("turns"), *[F.sum(k).alias(k) for k in LIMBS]
    ).withColumns({f"of_{k}": F.col(k) for k in LIMBS})
    blocks = stored(
        running(sums, ["conv_id"], ["block"], {k: F.col(k) for k in LIMBS}).select(
            "conv_id", "block", "turns",
            *[(F.col(k) - F.col(f"of_{k}")).alias(f"before_{k}") for k in LIMBS],
            _key([F.col(k) - F.col(f"of_{k}") for k in LIMBS]).alias("before"),
            _key([F.col(k) for k in LIMBS]).alias("after"),
        ),
        "trie-blocks",
    )
    groups = blocks.filter(F.col("turns") == BLOCK).groupBy("before", "after").agg(
        F.count("*").alias("members"), F.min("conv_id").alias("least")
    )
    above = groups.select(F.col("after").alias("before"), F.col("members").alias("around"))
    chains = groups.join(above, "before", "left").withColumn(
        "around", F.when(F.col("before") == ROOT, F.lit(all_convs)).otherwise(F.col("around"))
    ).filter("members = around").select("after", "members", "least")
    return (
        blocks.join(chains, "after", "left")
        .filter("least IS NULL OR least = conv_id")
        .select("conv_id", "block", "members", *[f"before_{k}" for k in LIMBS])
    )


def _nodes(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """``key, depth, parent, conv_id, n_convs, bytes`` of every node; the root has no parent."""
    everyone = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    total = everyone.first()["n_convs"]
    inside = (F.expr(f"(pos - 1) div {BLOCK}") == F.col("block")) & (
        F.col("conv_id") == F.col("block_conv")
    )
    blocks = _block_rows(rebuilt, total).withColumnRenamed("conv_id", "block_conv")
    turns = rebuilt.join(blocks, inside)
    earlier = "PARTITION BY conv_id, block ORDER BY pos ROWS UNBOUNDED PRECEDING"
    here = [F.col(f"before_{k}") + F.expr(f"sum({k}) OVER ({earlier})") for k in LIMBS]
    keyed = turns.select(
        "conv_id", F.col("pos").alias("depth"), "bytes", "members",
        _key(here).alias("key"),
        _key([limb - F.col(k) for limb, k in zip(here, LIMBS)]).alias("parent"),
    )
    kept = ["key", "depth", "parent", "conv_id", "n_convs", "bytes"]
    keyed = stored(keyed, "trie-turns")
    chained = keyed.filter("members IS NOT NULL").withColumn("n_convs", F.col("members")).select(kept)
    grouped = keyed.filter("members IS NULL").groupBy("key", "depth", "parent").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("bytes").alias("bytes")
    ).select(kept)
    root = everyone.filter("n_convs > 0").select(
        F.lit(ROOT).alias("key"), F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("string").alias("parent"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("bytes"),
    )
    return stored(chained.union(grouped).union(root), "trie-nodes")


def _totals(trees: DataFrame) -> DataFrame:
    """``conv_id, leaves, saved`` of whole subtrees of the stored ``conv_id, up, leaves, saved``.

    Every round adds up what points to a conversation and then lets all point twice as far up.
    """
    while not trees.filter("up IS NOT NULL").isEmpty():
        pointing = trees.filter("up IS NOT NULL")
        gained = pointing.groupBy(F.col("up").alias("conv_id")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        further = pointing.select(F.col("conv_id").alias("up"), F.col("up").alias("further"))
        trees = stored(
            trees.join(gained, "conv_id", "left").join(further, "up", "left").select(
                "conv_id", F.col("further").alias("up"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "trie-totals",
        )
    return trees.select("conv_id", "leaves", "saved")


def _ends(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of the nodes where conversations end."""
    sums = rebuilt.groupBy("conv_id").agg(*[F.sum(k).alias(k) for k in LIMBS])
    last = convs.join(sums, "conv_id", "left").select(
        "conv_id", F.expr(f"conv_id div {IDS} - int(conv_id % {IDS} < 0)").alias("part"),
        _key([F.coalesce(k, F.lit(0)) for k in LIMBS]).alias("key"),
    )
    parts = last.groupBy("key", "part").agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("piece")
    )
    return ordered_sha256(parts, ["key"], "part", "piece", ",", "ends_sha256")


def trie(turns: DataFrame) -> DataFrame:
    """One row per node: its smallest member, depth, parent, and counts over its subtree."""
    rebuilt, convs = rebuild(turns)
    nodes = _nodes(rebuilt, convs)
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = stored(
        nodes.join(children, "key", "left").join(parents, "parent", "left").select(
            "key", "depth", "parent", "parent_conv_id", "conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        ),
        "trie-known",
    )
    # A chain starts at the root, or where its parent has a smaller member.
    starts = known.filter("parent_conv_id IS NULL OR parent_conv_id <> conv_id").select(
        "conv_id", F.col("parent_conv_id").alias("up"), F.col("parent").alias("key")
    )
    chains = known.groupBy("conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    totals = stored(_totals(stored(starts.drop("key").join(chains, "conv_id"), "trie-chains")), "trie-sums")
    attached = starts.filter("up IS NOT NULL").join(totals, "conv_id").groupBy("key").agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )
    weighed = known.join(attached, "key", "left").withColumns({
        "leaves": F.col("leaves") + F.coalesce("more_leaves", F.lit(0)),
        "saved": F.col("saved") + F.coalesce("more_saved", F.lit(0)),
    }).withColumns({"own_leaves": F.col("leaves"), "own_saved": F.col("saved")}).drop(
        "more_leaves", "more_saved"
    )
    so_far = running(
        weighed, ["conv_id"], ["depth"], {"leaves": F.col("leaves"), "saved": F.col("saved")}
    )
    whole = totals.select("conv_id", F.col("leaves").alias("all_leaves"), F.col("saved").alias("all_saved"))
    return so_far.join(whole, "conv_id").join(_ends(rebuilt, convs), "key", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        (F.col("all_leaves") - F.col("leaves") + F.col("own_leaves")).alias("n_leaves"),
        (F.col("all_saved") - F.col("saved") + F.col("own_saved")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
