"""Data-quality checks as DataFrames of (check, passed, observed, expected).

All row rules of a table run in one pass over it. ``observed`` is a number (violating rows, a
count, a value), ``expected`` says in words what would have passed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.plans.registry import MartSpec
from starmill.session import stored

SCHEMA = "check string, passed boolean, observed double, expected string"

# Other names under which acceptance queries ask for gold columns.
COLUMN_ALIASES: dict[str, tuple[str, ...]] = {
    "order_year": ("year",),
    "year": ("order_year",),
    "order_month": ("month",),
    "month": ("order_month",),
    "average_installments": ("avg_installments", "payment_installments"),
    "total_revenue": ("revenue",),
    "revenue": ("total_revenue",),
}


@dataclass(frozen=True)
class Rule:
    """A predicate that every row must satisfy; a null outcome counts as a violation."""

    name: str
    predicate: Column = field(repr=False)
    expected: str = "no violating rows"


def satisfies(sql: str) -> Rule:
    return Rule(f"every row: {sql}", F.expr(sql))


def not_null(column: str) -> Rule:
    return Rule(f"not null: {column}", F.col(column).isNotNull(), "no null values")


def between(column: str, low: float, high: float) -> Rule:
    inside = F.col(column) >= low
    if high != float("inf"):
        inside &= F.col(column) <= high
    return Rule(f"between: {column}", inside, f"no value outside {low:g}..{high:g}")


def in_set(column: str, values: Sequence[str]) -> Rule:
    listed = ", ".join(map(str, values))
    return Rule(f"in set: {column}", F.col(column).isin(list(values)), f"only {listed}")


def period_scope(year: str, month: str, years: Sequence[int], months: Sequence[int]) -> list[Rule]:
    """No row outside the wanted years and months."""
    return [
        Rule(f"{what} scope: {c}", F.col(c).isin(list(v)), "only " + ", ".join(map(str, v)))
        for what, c, v in (("year", year, years), ("month", month, months))
    ]


def check_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All rules in a single aggregate; one result row per rule."""
    held = [F.coalesce(r.predicate, F.lit(False)) for r in rules]
    broken = df.agg(
        *[F.count(F.when(~h, 1)).cast("double").alias(f"r{i}") for i, h in enumerate(held)]
    )
    rows = [
        F.struct(
            F.lit(r.name).alias("check"),
            (F.col(f"r{i}") == 0).alias("passed"),
            F.col(f"r{i}").alias("observed"),
            F.lit(r.expected).alias("expected"),
        )
        for i, r in enumerate(rules)
    ]
    return broken.select(F.inline(F.array(*rows)))


def _single(one_row: DataFrame, name: str, passed: Column, observed: Column, expected) -> DataFrame:
    return one_row.select(
        F.lit(name).alias("check"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
        observed.cast("double").alias("observed"),
        (expected if isinstance(expected, Column) else F.lit(expected)).alias("expected"),
    )


def check_rowcount_equals_distinct(gold: DataFrame, source: DataFrame, column: str) -> DataFrame:
    """The gold table has one row per distinct source value."""
    distinct = source.agg(F.countDistinct(column)).scalar()
    counted = gold.agg(F.count("*").alias("rows")).withColumn("distinct", distinct)
    return _single(
        counted,
        f"row count equals distinct {column}",
        F.col("rows") == F.col("distinct"),
        F.col("rows"),
        F.format_string("%d rows", "distinct"),
    )


def check_unique_grain(gold: DataFrame, keys: Sequence[str]) -> DataFrame:
    """No key combination occurs twice; observed is the number that do."""
    repeated = gold.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    return _single(
        repeated.agg(F.count("*").alias("n")),
        f"unique grain: {', '.join(keys)}",
        F.col("n") == 0,
        F.col("n"),
        "no repeated key",
    )


def _bucket_sums(df: DataFrame, hashed: Sequence[str]) -> DataFrame:
    """Rows and order-free checksums per bucket: the halves of two hashes of each row, added up."""
    measures = [F.count("*").alias("rows")]
    missing = [F.col(c).isNull() for c in hashed]  # hashes pass over nulls
    for salt in (1, 2):
        code = F.xxhash64(F.lit(salt), *hashed, *missing)
        measures += [F.sum(code.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(code, 32))]
    names = [f"sum_{i}" for i in range(len(measures) - 1)]
    sums = [m.alias(n) for m, n in zip(measures[1:], names)]
    return df.groupBy("bucket").agg(measures[0], *sums)


def differing_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], buckets: int = 4096
) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables in those buckets of the keys whose checksums differ.

    Equal rows are only read and added up: both sides shuffle a row per bucket and task. Values
    compare as doubles where they are numbers, so that 1 equals 1.0. ``bucket`` is the last column.
    """
    kinds = dict(left.dtypes)
    hashed = [*keys, *values]

    def placed(df: DataFrame) -> DataFrame:
        def plain(name: str) -> Column:
            is_number = name in values and isinstance(df.schema[name].dataType, T.NumericType)
            return F.col(name).cast("double" if is_number else kinds[name])

        bucket = F.pmod(F.xxhash64(*[F.col(k).cast(kinds[k]) for k in keys]), F.lit(buckets))
        return df.withColumns({f"_{n}": plain(n) for n in hashed}).withColumn("bucket", bucket)

    sides = [placed(df) for df in (left, right)]
    sums = [_bucket_sums(df, [f"_{n}" for n in hashed]) for df in sides]
    other = sums[1].withColumnsRenamed({c: f"other_{c}" for c in sums[1].columns})
    equal = reduce(Column.__and__, [
        F.col(c).eqNullSafe(F.col(f"other_{c}")) for c in sums[0].columns if c != "bucket"
    ])
    wrong = sums[0].join(other, F.col("bucket") == F.col("other_bucket"), "full_outer").filter(~equal)
    # At most one row per bucket.
    asked = F.broadcast(wrong.select(F.coalesce("bucket", "other_bucket").alias("bucket")))
    found = [df.join(asked, "bucket", "left_semi") for df in sides]
    return found[0].select(*left.columns, "bucket"), found[1].select(*right.columns, "bucket")


def check_reconcile(
    gold: DataFrame,
    recomputed: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    tolerance: float = 0.005,
) -> DataFrame:
    """Gold equals the recomputed table: same keys, measures within the tolerance.

    Null keys match null keys. Observed is the number of differing or unmatched keys. Only buckets
    of keys with different checksums are joined, so tables that agree shuffle next to nothing; the
    recomputed table is stored, since it is read for the checksums and for the join.
    """
    wanted = [*keys, *measures]
    mine, theirs = differing_buckets(
        gold.select(*wanted), stored(recomputed.select(*wanted), "reconcile"), keys, measures
    )
    left = mine.withColumn("in_gold", F.lit(True)).alias("g")
    right = theirs.withColumn("in_bronze", F.lit(True)).alias("b")
    same_key = reduce(
        Column.__and__, [F.col(f"g.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    )
    both = left.join(right, same_key, "full_outer")
    agrees = F.col("in_gold").isNotNull() & F.col("in_bronze").isNotNull()
    for m in measures:
        g, b = F.col(f"g.{m}"), F.col(f"b.{m}")
        agrees &= (g.isNull() & b.isNull()) | F.coalesce(F.abs(g - b) <= tolerance, F.lit(False))
    return _single(
        both.agg(F.count(F.when(~agrees, 1)).alias("n")),
        f"reconciles with bronze: {', '.join(measures)}",
        F.col("n") == 0,
        F.col("n"),
        f"no key differs by more than {tolerance:g}",
    )


def check_spot_values(
    gold: DataFrame,
    recomputed: DataFrame,
    spots: Sequence[Mapping[str, object]],
    measure: str,
    tolerance: float = 0.005,
) -> DataFrame:
    """The measure at some keys equals the values recomputed for them; one pass over each side.

    ``recomputed`` should be cut to the spots' periods before it is aggregated, where the cut
    reaches the scan.
    """
    places = [reduce(Column.__and__, [F.col(k) == v for k, v in at.items()]) for at in spots]
    wanted = reduce(Column.__or__, places)

    def values(df: DataFrame) -> DataFrame:
        return df.filter(wanted).agg(F.struct(*[
            F.max(F.when(place, F.col(measure))).alias(f"v{i}") for i, place in enumerate(places)
        ]).alias("at"))

    both = values(gold).withColumn("want", values(recomputed).scalar())
    rows = [
        F.struct(
            F.lit(i).alias("i"), F.col(f"at.v{i}").alias("found"), F.col(f"want.v{i}").alias("want"),
            F.lit(f"spot value: {measure} at " + ", ".join(f"{k}={v}" for k, v in at.items()))
            .alias("check"),
        )
        for i, at in enumerate(spots)
    ]
    close = F.abs(F.col("found") - F.col("want")) <= tolerance
    return both.select(F.inline(F.array(*rows))).select(
        "check",
        F.coalesce(close, F.lit(False)).alias("passed"),
        F.col("found").cast("double").alias("observed"),
        F.lit(f"the value recomputed from bronze, within {tolerance:g}").alias("expected"),
    )


def check_spot_value(
    gold: DataFrame,
    recomputed: DataFrame,
    at: Mapping[str, object],
    measure: str,
    tolerance: float = 0.005,
) -> DataFrame:
    """``check_spot_values`` for one key."""
    return check_spot_values(gold, recomputed, [at], measure, tolerance)


def check_non_empty(gold: DataFrame, column: str | None = None, minimum: int = 1) -> DataFrame:
    """At least ``minimum`` rows, or distinct values of ``column``."""
    amount = F.countDistinct(column) if column else F.count("*")
    what = f"distinct {column}" if column else "rows"
    return _single(
        gold.agg(amount.alias("n")),
        f"non-empty: {what}",
        F.col("n") >= minimum,
        F.col("n"),
        f"at least {minimum}",
    )


def check_allowlist(
    gold: DataFrame, column: str, allowed: DataFrame, allowed_column: str
) -> DataFrame:
    """Every value of ``column`` occurs in the allowed list; observed counts the strangers."""
    values = gold.select(F.col(column).alias("v")).filter("v IS NOT NULL").distinct()
    known = allowed.select(F.col(allowed_column).alias("v")).distinct()
    return _single(
        values.join(known, "v", "left_anti").agg(F.count("*").alias("n")),
        f"allowlist: {column}",
        F.col("n") == 0,
        F.col("n"),
        f"only values of {allowed_column}",
    )


def with_aliases(gold: DataFrame) -> DataFrame:
    """Add the other names that acceptance queries use for the table's columns."""
    have = set(gold.columns)
    extra = {a: F.col(c) for c in gold.columns for a in COLUMN_ALIASES.get(c, ()) if a not in have}
    return gold.withColumns(extra) if extra else gold


def check_acceptance_sql(
    spark: SparkSession, gold: Mapping[str, DataFrame], criteria: Sequence[str]
) -> DataFrame:
    """Run acceptance queries over stored gold tables given by name.

    Every query reads its table anew, so pass tables that were written, not unwritten marts.
    One number passes if it is neither null nor zero. Anything else is a listing, which passes if
    it has a row that is not all null. A query that names a missing table or column is a failed
    check. The views that the queries name exist only while this function runs.
    """
    prefix = f"gold_view_{uuid.uuid4().hex}_"
    for name, df in gold.items():
        with_aliases(df).createOrReplaceTempView(prefix + name)
    try:
        return union([_criterion(spark, sql, prefix) for sql in criteria])
    finally:
        for name in gold:
            spark.catalog.dropTempView(prefix + name)


def _criterion(spark: SparkSession, sql: str, prefix: str) -> DataFrame:
    try:
        found = spark.sql(re.sub(r"\bgold\.(?=\w)", prefix, sql))
    except AnalysisException as error:
        reason = (error.getCondition() or "ANALYSIS_ERROR").lower()
        failed = spark.range(1).select(F.lit(None).cast("double").alias("v"))
        return _single(failed, sql, F.lit(False), F.col("v"), f"runs ({reason})")
    columns = [F.col(f"`{c}`") for c in found.columns]
    filled = F.count(F.when(reduce(Column.__or__, [c.isNotNull() for c in columns]), 1))
    number = len(columns) == 1 and isinstance(found.schema[0].dataType, T.NumericType)
    value = F.max(columns[0].cast("double")) if number else F.lit(None).cast("double")
    measured = found.agg(
        F.count("*").alias("n"), filled.alias("filled"), value.alias("value")
    )
    alone = F.lit(number) & (F.col("n") == 1)
    return _single(
        measured,
        sql,
        F.when(alone, F.col("value") != 0).otherwise(F.col("filled") > 0),
        F.when(alone, F.col("value")).otherwise(F.col("n")),
        F.when(alone, F.lit("not null and not zero")).otherwise(F.lit("some rows")),
    )


def union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def mart_rules(spec: MartSpec) -> list[Rule]:
    """The row rules that a mart's specification promises."""
    rules = [satisfies(f"{c} > 0") for c in spec.positive]
    rules += [not_null(c) for c in spec.not_null]
    rules += [between(c, *limits) for c, limits in spec.between.items()]
    return rules + [in_set(c, values) for c, values in spec.in_set.items()]


def mart_checks(table: DataFrame, spec: MartSpec) -> list[DataFrame]:
    """Every check that a mart's specification implies, over the stored table."""
    rules = mart_rules(spec)
    found = [check_rows(table, rules)] if rules else []
    if spec.grain:
        found.append(check_unique_grain(table, spec.grain))
    return [*found, check_non_empty(table)]


AUDIT_SCHEMA = (
    "check string, passed boolean, severity string, message string, overall_passed boolean,"
    " score double, run_id string"
)


def validation_report(parts: Mapping[str, Sequence[DataFrame]]) -> DataFrame:
    """All checks with a severity (the mapping's key), a message and the overall verdict.

    The table passes if no check of severity ``error`` failed; the score is the share of
    passed checks.
    """
    rows = union(
        [df.withColumn("severity", F.lit(level)) for level, dfs in parts.items() for df in dfs]
    )
    every = Window.partitionBy(F.lit(1))  # a handful of rows: one per check
    ok = F.col("passed") | (F.col("severity") != "error")
    observed = F.coalesce(F.format_number("observed", 2), F.lit("nothing"))
    return rows.select(
        "check",
        "passed",
        "severity",
        F.concat(F.lit("observed "), observed, F.lit(", expected "), "expected").alias("message"),
        F.min(ok).over(every).alias("overall_passed"),
        F.avg(F.col("passed").cast("int")).over(every).alias("score"),
    )


def append_audit(report: DataFrame, path: str, run_id: str) -> str:
    """Add a validation report to the audit table at ``path``.

    Every run has a partition of its own, which a retry of that run replaces.
    """
    keyed = report.withColumn("run_id", F.lit(run_id))
    keyed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id"
    ).parquet(path)
    return path


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit table; run ids stay text, also where they look like numbers."""
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)
