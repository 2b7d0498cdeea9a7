"""Connected components of a stored edge table, by repeated contraction.

Each round every node points to its smallest neighbour (or itself), the pointers are followed to
their roots by jumping, and the edges are rewritten to roots. Every node of an edge loses at least
one partner per round, so the number of rounds grows with the logarithm of the nodes. All steps are
shuffled joins and partial aggregations over tables in the shared folder; only emptiness is asked by
the driver. A root with very many members is a skewed join key, which AQE splits, since nothing
above those joins needs the key's rows together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.session import stored


def _follow(pointers: DataFrame) -> DataFrame:
    """``node, root`` with every root pointing to itself, by pointer jumping, two steps at a time."""
    while True:
        first = pointers.select(F.col("node").alias("root"), F.col("root").alias("ahead"))
        second = pointers.select(F.col("node").alias("ahead"), F.col("root").alias("beyond"))
        pointers = stored(
            pointers.join(first, "root").join(second, "ahead").select(
                "node", F.col("beyond").alias("root"), (F.col("beyond") != F.col("ahead")).alias("moved")
            ),
            "components-roots", narrow=True,
        )
        if pointers.filter("moved").isEmpty():
            return pointers.select("node", "root")
        pointers = pointers.select("node", "root")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a`` and ``b``, never null).

    The root is one node of the component, the same for all of its nodes. Loops and repeated edges
    do no harm; a node that has only a loop, or no edge, is not in the result.
    """
    links = stored(edges.select("a", "b").filter("a <> b"), "components-edges", narrow=True)
    found = None
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("b"))
        roots = _follow(stored(
            least.select(F.col("a").alias("node"), F.least("a", "b").alias("root")),
            "components-pointers", narrow=True,
        ))
        side = {
            name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
            for name in ("a", "b")
        }
        links = stored(
            links.join(side["a"], "a").join(side["b"], "b")
            .filter("a_root <> b_root")
            .select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
            .distinct(),
            "components-edges", narrow=True,
        )
        if found is None:
            found = roots
        else:
            later = roots.select(F.col("node").alias("root"), F.col("root").alias("later"))
            found = stored(
                found.join(later, "root", "left").select(
                    "node", F.coalesce("later", "root").alias("root")
                ),
                "components-found", narrow=True,
            )
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).filter("false")
    return found


def extended(roots: DataFrame, edges: DataFrame) -> DataFrame:
    """``node, root`` of the components of earlier edges, whose stored ``roots`` are given, and of new ones.

    Only new edges between different components are contracted, so edges that come in several parts
    cost no more rounds over the earlier ones.
    """
    side = {
        name: roots.select(F.col("node").alias(name), F.col("root").alias(f"{name}_root"))
        for name in ("a", "b")
    }
    later = components(
        edges.join(side["a"], "a", "left").join(side["b"], "b", "left").select(
            F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b")
        ).distinct()
    )
    ahead = later.select(F.col("node").alias("root"), F.col("root").alias("later"))
    moved = roots.join(ahead, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    added = later.join(roots.select("node"), "node", "left_anti").select("node", "root")
    return stored(moved.union(added), "components-extended", narrow=True)
