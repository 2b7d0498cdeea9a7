"""Column profiles of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.functions import number as known_number
from starmill.operators.quantiles import exact_quantiles, value_counts


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def profile_columns(
    df: DataFrame,
    quartiles: Sequence[float] = (0.25, 0.5, 0.75),
    distinct_error: float | None = None,
) -> DataFrame:
    """One row per column: type, counts, distinct values, and for numbers their distribution.

    The plain statistics are one aggregate without a shuffle. Distinct values are counted per
    (column, value) in the columns' own types, one shuffle per type. With ``distinct_error`` they
    are estimated to that relative error inside the plain aggregate. Quartiles are exact.
    """
    numbers = set(numeric_columns(df))
    aggs, rows = [], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        known = known_number(c) if f.name in numbers else F.lit(None).cast("double")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(known.isNotNull(), c)  # NaN and the infinities are missing
        measures = {
            "count": F.count(c),
            "missing": F.count(F.when(c.isNull(), 1)),
            "min": F.min(c).cast("string"),
            "max": F.max(c).cast("string"),
            "mean": F.avg(known),
            "std": F.stddev(known),
            "zeros": F.count(F.when(known == 0, 1)),
        }
        if distinct_error is not None:
            measures["distinct"] = F.approx_count_distinct(c, distinct_error)
        aggs += [m.alias(f"{k}_{i}") for k, m in measures.items()]
        rows.append(
            F.struct(
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("type"),
                *[F.col(f"{k}_{i}").alias(k) for k in measures],
            )
        )
    result = df.agg(*aggs).select(F.inline(F.array(*rows)))
    if distinct_error is None:
        by_type: dict[str, list[str]] = {}
        for f in df.schema.fields:
            kind = f.dataType.simpleString() if isinstance(f.dataType, T.AtomicType) else "string"
            by_type.setdefault(kind, []).append(f.name)
        counts = [
            value_counts(df, names, kind).groupBy("column").agg(F.count("*").alias("distinct"))
            for kind, names in by_type.items()
        ]
        distinct = reduce(DataFrame.unionAll, counts)
        result = result.join(distinct, "column", "left").fillna(0, ["distinct"])
    names = [f"p{round(q * 100)}" for q in quartiles]
    if not numbers:
        nothing = F.lit(None).cast("double")
        return result.withColumns({n: nothing for n in names})
    shape = (
        exact_quantiles(df, sorted(numbers), quartiles)
        .groupBy("column")
        .agg(
            *[
                F.max(F.when(F.col("probability") == q, F.col("value"))).alias(n)
                for q, n in zip(quartiles, names)
            ]
        )
    )
    return result.join(shape, "column", "left")


def profile_top_values(df: DataFrame, columns: Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent values of each column, ties in value order.

    Spark cuts each task's rows to the first ``k`` ranks before they meet in one place.
    """
    best = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (
        value_counts(df, columns, "string")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("column", "rank", "value", "n")
    )


def profile_histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """All ``bins`` equal-width bins of each numeric column, empty ones with count 0.

    The last bin includes the maximum. NaN and the infinities count as missing; a column
    without values has bins without edges. A column of one value has it in its first bin.
    """
    values = df.select(*[known_number(f"`{c}`").alias(c) for c in columns])
    limits = values.agg(
        *[F.min(f"`{c}`").alias(f"low_{i}") for i, c in enumerate(columns)],
        *[F.max(f"`{c}`").alias(f"high_{i}") for i, c in enumerate(columns)],
    )
    edges = limits.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"low_{i}").alias("low"),
                        F.col(f"high_{i}").alias("high"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    long = values.unpivot([], list(columns), "column", "value").filter("value IS NOT NULL")
    width = F.nullif(F.col("high") - F.col("low"), F.lit(0.0))
    position = F.floor((F.col("value") - F.col("low")) / width * bins)
    counts = (
        long.join(F.broadcast(edges), "column")  # one row per column
        .groupBy(
            "column",
            F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"),
        )
        .agg(F.count("*").alias("n"))
    )
    step = (F.col("high") - F.col("low")) / bins
    every = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(counts, ["column", "bin"], "left").select(
        "column",
        "bin",
        (F.col("low") + F.col("bin") * step).alias("bin_start"),
        (F.col("low") + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def profile_correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, in one aggregate."""
    pairs = list(combinations(columns or numeric_columns(df), 2))
    found = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = [
        F.struct(
            F.lit(a).alias("column_a"),
            F.lit(b).alias("column_b"),
            F.col(f"c{i}").alias("correlation"),
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return found.select(F.inline(F.array(*rows)))


def profile_smoke(df: DataFrame) -> DataFrame:
    """One row: row count, share of null cells, and rows that repeat another row.

    Only the repeated rows need a shuffle; the other two are one plain aggregate.
    """
    cells = [F.col(f"`{c}`").isNull().cast("int") for c in df.columns]
    distinct = df.distinct().agg(F.count("*")).scalar()
    share = F.sum(sum(cells[1:], cells[0])) / (F.count("*") * len(cells))
    plain = df.agg(
        F.count("*").alias("row_count"),
        F.when(F.count("*") > 0, share).otherwise(0.0).alias("null_share"),
    )
    return plain.withColumn("duplicate_rows", F.col("row_count") - distinct)
