"""Running sums and ranks in a total order, without a window that sees all rows of a group.

A window over a hot group, or over no group at all, puts its rows into one task. Here the rows are
dealt by ranges of (keys, order); every range sums up its own share, and the few groups that lie in
several ranges get the sums of the ranges before theirs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.session import stored

PART = "_scan_part"


def _other(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``df`` with these columns renamed, to be the right side of a join."""
    return df.withColumnsRenamed({n: f"_of_{n}" for n in names})


def _same(names: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_of_{n}")) for n in names])


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """``df`` with a column per entry of ``sums``: its running sum, the row's own value included.

    Groups are the values of ``keys`` (null is one), each in ascending order of the columns
    ``order``, nulls first. Rows that agree in both stand in any order and in one range, so name
    columns that tell them apart. The summed values must not be negative. A group in several ranges
    is the first or last of each, so offsets are at most two rows per range; only they are broadcast,
    and a window over them sees one row per range. The rows are written to the shared folder once.
    """
    dealt = (
        df.withColumns(sums)
        .repartitionByRange(*keys, *order)
        .withColumn(PART, F.spark_partition_id())
    )
    so_far = (
        Window.partitionBy(PART, *keys)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = stored(dealt.withColumns({n: F.sum(n).over(so_far) for n in sums}), "scan")
    totals = local.groupBy(PART, *keys).agg(*[F.max(n).alias(n) for n in sums])
    several = (
        totals.groupBy(*keys)
        .agg(F.min(PART).alias("_first"), F.max(PART).alias("_last"))
        .filter("_first < _last")
    )
    earlier = (
        Window.partitionBy(*keys)
        .orderBy(PART)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    crossing = totals.join(F.broadcast(_other(several, keys)), _same(keys), "left_semi")
    offsets = crossing.select(
        PART, *keys, *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums]
    )
    place = [PART, *keys]
    joined = local.join(F.broadcast(_other(offsets, place)), _same(place), "left")
    return joined.select(
        *[c for c in df.columns if c not in sums],
        *[(F.col(n) + F.coalesce(f"_before_{n}", F.lit(0))).alias(n) for n in sums],
    )


def dense_rank(df: DataFrame, keys: Sequence[str], label: str, rank: str) -> DataFrame:
    """(keys, label, rank): the distinct labels of each group, numbered from one in their order."""
    labels = df.select(*keys, label).distinct()
    return running(labels, keys, [label], {rank: F.lit(1)})
