"""Chart-ready aggregates of gold tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import (
    NUMBER_PATTERN,
    in_period,
    label_or_unknown,
    month_label,
    number_or_zero,
)
from starmill.operators.quantiles import value_counts
from starmill.operators.scans import dense_rank
from starmill.session import stored

# Column names that are read as time.
TIME_COLUMNS = (
    "order_year", "order_quarter", "order_month", "year", "month", "quarter", "order_date"
)

Label = Callable[[str, str], Column]


def _total(metric: str):
    return F.sum(number_or_zero(metric)).alias(metric)


def line(
    df: DataFrame,
    year: str,
    part: str,
    metric: str,
    years: Sequence[int] | None = None,
    parts: Sequence[int] | None = None,
    label: Label = month_label,
) -> DataFrame:
    """The metric per month in time order, inside the wanted scope.

    With ``label=quarter_label`` the ``part`` of the year is a quarter.
    """
    if years is not None and parts is not None:
        df = df.filter(in_period(year, part, years, parts))
    return (
        df.groupBy(year, part)
        .agg(_total(metric))
        .select(label(year, part).alias("period"), metric)
        .orderBy("period")
    )


def rank(df: DataFrame, category: str, metric: str, n: int = 10) -> DataFrame:
    """The ``n`` largest categories; rows are ranked before they are cut."""
    return (
        df.groupBy(label_or_unknown(category).alias(category))
        .agg(_total(metric))
        .orderBy(F.desc(metric), category)
        .limit(n)
    )


def surface(
    df: DataFrame,
    year: str,
    part: str,
    series: str,
    metric: str,
    label: Label = month_label,
) -> DataFrame:
    """Period x series x metric for a 3-D chart, with dense axis positions from zero.

    The points are stored, since the axes need them too. Both axes' distinct labels are numbered by
    ranges, so an axis of any length is never in one task.
    """
    points = stored(
        df.groupBy(
            label(year, part).alias("period"), label_or_unknown(series).alias("series")
        ).agg(_total(metric)),
        "surface-points",
    )
    labels = points.unpivot([], ["period", "series"], "axis", "label")
    places = stored(dense_rank(labels, ["axis"], "label", "place"), "surface-axes")

    def axis(name: str) -> DataFrame:
        return places.filter(F.col("axis") == name).select(
            F.col("label").alias(name), (F.col("place") - 1).cast("int").alias(f"{name}_idx")
        )

    return points.join(axis("period"), "period").join(axis("series"), "series").select(
        "period", "series", metric, "period_idx", "series_idx"
    )


def grouped_bar(df: DataFrame, label: str, group: str, metric: str) -> DataFrame:
    """The metric per pair of categories."""
    return df.groupBy(
        label_or_unknown(label).alias(label), label_or_unknown(group).alias(group)
    ).agg(_total(metric))


def scatter(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """Two metrics per key; points without both values are not drawn."""
    return df.select(*keys, F.col(x).alias("x"), F.col(y).alias("y")).filter(
        "x IS NOT NULL AND y IS NOT NULL"
    )


def composition(df: DataFrame, category: str, metric: str) -> DataFrame:
    """Share of the total per category, largest first, and the number of categories.

    Whether so many categories make a pie or a bar chart is for the caller to say.
    """
    parts = df.groupBy(label_or_unknown(category).alias(category)).agg(_total(metric))
    whole = parts.agg(
        F.struct(F.sum(metric).alias("total"), F.count("*").alias("categories"))
    ).scalar()
    return (
        parts.withColumn("whole", whole)
        .select(
            category,
            metric,
            (F.col(metric) / F.nullif(F.col("whole.total"), F.lit(0.0))).alias("share"),
            F.col("whole.categories").alias("categories"),
        )
        .orderBy(F.desc(metric), category)
    )


def column_roles(df: DataFrame, long_label: float = 15) -> DataFrame:
    """Classify every column as time, metric or category for chart selection.

    A metric has only values that read as numbers (blank text is ignored). Categories whose
    labels are longer than ``long_label`` on average are marked as horizontal. A column without
    values is a category without labels.
    """
    counts = value_counts(df, df.columns, "string").filter("value != ''")
    number = F.col("value").rlike(NUMBER_PATTERN)
    listed = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(i).alias("position"))
        for i, c in enumerate(df.columns)
    ])
    columns = df.sparkSession.range(1).select(F.inline(listed))
    found = counts.groupBy("column").agg(
        F.sum("n").alias("n_values"),
        F.count("*").alias("n_distinct"),
        F.bool_and(number).alias("numeric"),
        (F.sum(F.length("value") * F.col("n")) / F.sum("n")).alias("avg_label_length"),
    )
    role = (
        F.when(F.col("column").isin(*TIME_COLUMNS), "time")
        .when(F.col("numeric"), "metric")
        .otherwise("category")
    )
    return columns.join(found, "column", "left").select(
        "column",
        "position",
        role.alias("role"),
        F.coalesce("n_values", F.lit(0)).alias("n_values"),
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        F.when(role == "category", F.col("avg_label_length")).alias("avg_label_length"),
        F.coalesce(
            (role == "category") & (F.col("avg_label_length") > long_label), F.lit(False)
        ).alias("horizontal"),
    )
