"""Exact quantiles of whole columns without gathering a column in one task.

``percentile`` keeps every distinct value of a column in a single task, and a global window sorts the
column in one. Here a mergeable sketch brackets each wanted rank in one pass, and a second pass counts
exactly: how many values lie between the brackets, and how often each value inside a bracket occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import number
from starmill.operators.scans import running

# A KLL sketch of size k is off by less than 2.3 / k**0.9 of the rows with 99 % confidence; brackets
# reach twice as far. At this size they hold 0.08 % of the rows, and a sketch is below a megabyte.
SKETCH = 1 << 15
MARGIN = 2 * 2.3 / SKETCH**0.9

Brackets = dict[str, list[tuple[float, float]]]


def value_counts(df: DataFrame, columns: Sequence[str], kind: str = "double") -> DataFrame:
    """(column, value, n): how often every known value occurs in each of the columns.

    As doubles, whole numbers above 2**53 are rounded, and NaN and the infinities are left out.
    """
    long = df.select(*[F.col(f"`{c}`").cast(kind).alias(c) for c in columns]).unpivot(
        [], [f"`{c}`" for c in columns], "column", "value"
    )
    known = F.col("value").isNotNull()
    if kind in ("double", "float"):
        known &= F.abs("value") < float("inf")  # neither NaN
    return (
        long.filter(known)
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def _ranks(n: int, probability: float) -> tuple[int, int, float]:
    """The two neighbouring ranks of a quantile, and the share of the second."""
    place = (n - 1) * probability
    return int(place), min(int(place) + (place > int(place)), n - 1), place - int(place)


def _brackets(
    values: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> tuple[dict[str, int], Brackets]:
    """Each column's number of values, and disjoint ascending spans around the wanted ranks."""
    sketches = values.agg(
        *[F.kll_sketch_agg_double(F.col(f"`{c}`"), F.lit(SKETCH)).alias(f"k{i}")
          for i, c in enumerate(columns)],
        *[F.struct(F.count(f"`{c}`").alias("n"), F.min(f"`{c}`").alias("low"),
                   F.max(f"`{c}`").alias("high")).alias(f"r{i}") for i, c in enumerate(columns)],
    )
    shares = {(p, side): p + side * MARGIN for p in probabilities for side in (-1, 1)}
    row = sketches.select(
        "*",
        *[F.when(F.col(f"r{i}.n") > 0, F.kll_sketch_get_quantile_double(
            F.col(f"k{i}"), F.lit(min(max(share, 0.0), 1.0)))).alias(f"q{i}_{j}")
          for i in range(len(columns)) for j, share in enumerate(shares.values())],
    ).drop(*[f"k{i}" for i in range(len(columns))]).first()
    counts, found = {}, {}
    for i, c in enumerate(columns):
        counts[c], low, high = row[f"r{i}"]
        ends = {}
        for j, ((p, side), share) in enumerate(shares.items()):
            outside = low if share <= 0 else high if share >= 1 else row[f"q{i}_{j}"]
            ends.setdefault(p, []).append(outside)
        found[c] = _merged([tuple(e) for e in ends.values()]) if counts[c] else []
    return counts, found


def _merged(spans: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    merged: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if merged and low <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(merged[-1][1], high))
        else:
            merged.append((low, high))
    return merged


def _counted(values: DataFrame, brackets: Brackets) -> DataFrame:
    """(column, place, value, n): even places lie between the spans and have no value."""
    rows = []
    for c, spans in brackets.items():
        value, place = F.col(f"`{c}`"), F.lit(2 * len(spans))
        for i, (low, high) in reversed(list(enumerate(spans))):
            place = F.when(value < low, 2 * i).when(value <= high, 2 * i + 1).otherwise(place)
        rows.append(F.struct(F.lit(c).alias("column"), place.alias("place"), value.alias("value")))
    inside = F.when(F.col("place") % 2 == 1, F.col("value"))
    return (
        values.select(F.explode(F.array(*rows)).alias("of"))
        .select("of.*")
        .filter("value IS NOT NULL")
        .groupBy("column", "place", inside.alias("value"))
        .agg(F.count("*").alias("n"))
    )


def _wanted(counts: dict[str, int], probabilities: Sequence[float]) -> Column:
    """Per row of counted values, the wanted ranks that it holds."""
    wanted = F.create_map(*[
        part for c, n in counts.items()
        for part in (F.lit(c), F.array(*[
            F.struct(F.lit(float(p)).alias("probability"), F.lit(rank).cast("long").alias("rank"),
                     F.lit(share).alias("share"))
            for p in probabilities for *ranks, share in [_ranks(n, p)] for rank in set(ranks)
        ]))
    ])
    return F.filter(
        wanted[F.col("column")],
        lambda w: (w["rank"] >= F.col("upto") - F.col("n")) & (w["rank"] < F.col("upto")),
    )


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    """(column, probability, value), interpolated linearly between neighbouring ranks.

    ``df`` is read twice now: for the sketches and for the counts. The driver gets a row of bracket
    ends. Counted values are numbered by ranges, so neither a wide bracket nor a hot value meets in one
    task. Should a sketch have missed a rank, the gap that holds it is counted value by value.
    """
    values = df.select(*[number(F.col(f"`{c}`")).alias(c) for c in columns])
    counts, brackets = _brackets(values, columns, probabilities)
    counts = {c: n for c, n in counts.items() if n}
    if not counts:
        return df.sparkSession.createDataFrame([], "column string, probability double, value double")
    while True:
        placed = running(
            _counted(values, {c: brackets[c] for c in counts}),
            ["column"], ["place", "value"], {"upto": F.col("n")},
        )
        hits = placed.select("column", "place", "value", F.inline(_wanted(counts, probabilities)))
        missed = hits.filter("place % 2 = 0").select("column", "place").distinct().collect()
        if not missed:
            break
        for c, place in missed:
            spans, i = brackets[c], place // 2
            low = spans[i - 1][1] if i else float("-inf")
            high = spans[i][0] if i < len(spans) else float("inf")
            brackets[c] = _merged([*spans, (low, high)])
    low, high = F.min("value"), F.max("value")
    return hits.groupBy("column", "probability").agg(
        (low + (high - low) * F.max("share")).alias("value")
    )


def cut_points(cuts: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> Column:
    """``exact_quantiles`` as a scalar subquery: a struct with one field ``<column>_<i>`` each."""
    fields = [
        F.max(
            F.when((F.col("column") == c) & (F.col("probability") == p), F.col("value"))
        ).alias(f"{c}_{i}")
        for c in columns
        for i, p in enumerate(probabilities)
    ]
    return cuts.agg(F.struct(*fields)).scalar()
