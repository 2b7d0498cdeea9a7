"""Sums of doubles that lose no digit and do not depend on row order.

A plain sum of doubles changes in its last digits from run to run, and after a lost executor; a gold
table should not. Here a value is a whole number of units of its bin. Bins span ``BITS`` powers of two,
so the bins of all doubles there are number about ninety, and a group usually has one or two. Rows are
summed per group and bin in four limbs of ``BITS`` bits, as 64-bit integers, exact for 5e11 rows; their
carries are brought forward before sums are summed again. At the end a group's bins become one number,
rounded once. NaN and infinite values count as missing; a group without values has no sum.

    limbs = with_limbs(lines, spent="price")
    per_product = add_up(limbs, ["product_id"], ["spent"])            # may be summed again
    totals(per_product.join(...), ["category"], ["spent"])            # doubles
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions import number

BITS = 24
LIMBS = 4
MASK = (1 << BITS) - 1
# 2**(BITS * bin - UNIT) is a bin's unit, at most the last bit of its values. A value's size is taken
# from a logarithm, which may be one off; SIZES makes the smallest bin number zero.
SIZES = 1083
UNIT = SIZES + 53


def _limbs(name: str) -> list[str]:
    return [f"{name}_{i}" for i in range(LIMBS)]


def with_limbs(df: DataFrame, **amounts: str | Column) -> DataFrame:
    """``df`` with the bin and the limbs of each amount, as columns ``<name>_bin`` and ``<name>_0`` on."""
    for name, amount in amounts.items():
        value = number(amount)
        size = F.floor(F.log2(F.nullif(F.abs(value), F.lit(0.0))))
        place = F.floor((F.coalesce(size, F.lit(0)) + SIZES) / BITS).cast("int")
        # Powers of two are exact; two halves keep every step in range.
        half = F.pow(F.lit(2.0), ((UNIT - BITS * F.col(f"{name}_bin")) / 2))
        df = df.withColumn(f"{name}_bin", F.when(value.isNotNull(), place))
        rest, limbs = F.abs(value) * half * half, []
        for i in reversed(range(1, LIMBS)):
            limbs.append(F.floor(rest / 2.0 ** (BITS * i)))
            rest = rest - limbs[-1].cast("double") * 2.0 ** (BITS * i)
        limbs.append(rest.cast("bigint"))
        sign = F.signum(value).cast("bigint")
        df = df.withColumns({c: limb * sign for c, limb in zip(_limbs(name), reversed(limbs))})
    return df


def _carried(name: str) -> list[Column]:
    """The summed limbs with all but the last below 2**BITS."""
    found, carry = [], F.lit(0).cast("bigint")
    for limb in _limbs(name)[:-1]:
        total = F.col(limb) + carry
        found.append(total.bitwiseAND(F.lit(MASK)).alias(limb))
        carry = F.shiftright(total, BITS)
    last = _limbs(name)[-1]
    return [*found, (F.col(last) + carry).alias(last)]


def add_up(
    df: DataFrame,
    keys: Sequence[str | Column],
    amounts: Sequence[str],
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """Sums per group and bin, which may be added up again; a group may have several rows.

    ``counts`` are further aggregates; ``totals`` adds up theirs, and takes the largest of ``latest``.
    """
    counts = counts or {}
    limbs = [limb for name in amounts for limb in _limbs(name)]
    summed = df.groupBy(*keys, *[f"{name}_bin" for name in amounts]).agg(
        *[F.sum(limb).alias(limb) for limb in limbs], *[c.alias(n) for n, c in counts.items()]
    )
    kept = [c for c in summed.columns if c not in limbs]
    return summed.select(*kept, *[limb for name in amounts for limb in _carried(name)])


def totals(
    df: DataFrame,
    keys: Sequence[str | Column],
    amounts: Sequence[str],
    counts: dict[str, Column] | None = None,
    latest: dict[str, Column] | None = None,
) -> DataFrame:
    """One row per group: keys, the amounts' sums as doubles, the counts, and largest values."""
    counts, latest = counts or {}, latest or {}
    summed = add_up(df, keys, amounts, {**counts, **latest})
    names = summed.columns[:len(keys)]
    bins = {
        name: F.collect_list(F.when(
            F.col(f"{name}_bin").isNotNull(),
            F.struct(
                F.col(f"{name}_bin").cast("bigint").alias("bin"),
                *[F.col(limb).alias(f"s{i}") for i, limb in enumerate(_limbs(name))],
            ),
        ))
        for name in amounts
    }
    joined = summed.groupBy(*names).agg(
        *[c.alias(n) for n, c in bins.items()], *[F.sum(n).alias(n) for n in counts],
        *[F.max(n).alias(n) for n in latest],
    )
    return joined.select(*names, *[_number(n).alias(n) for n in amounts], *counts, *latest)


def once(df: DataFrame, keys: Sequence[str], amount: str, name: str) -> DataFrame:
    """``add_up``'s rows with a column that is 1 in one row of each group, else 0.

    The row has a bin if any row of the group has one.
    """
    row = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last(f"{amount}_bin")))
    return df.withColumn(name, F.when(row == 1, F.lit(1)).otherwise(F.lit(0)).cast("bigint"))


def _number(bins: str) -> Column:
    """The double nearest to the sum of a group's bins."""
    only = f"{bins}[0]"
    narrow = f"abs({only}.s3) < {1 << 28}"
    single = _scaled(
        f"({only}.s3 * {1 << BITS} + {only}.s2)", f"({only}.s1 * {1 << BITS} + {only}.s0)", f"{only}.bin"
    )
    several = _signed(f"{bins}")
    return F.expr(
        f"CASE WHEN size({bins}) = 0 THEN NULL"
        f" WHEN size({bins}) = 1 AND {narrow} THEN {single} ELSE {several} END"
    )


def _scaled(high: str, low: str, place: str) -> str:
    """(high * 2**48 + low) units of a bin: one rounding, then exact powers of two."""
    power = f"({BITS} * {place} - {UNIT})"
    return (
        f"(cast({high} AS double) * {2.0 ** (2 * BITS)!r}D + {low})"
        f" * pow(2.0D, floor({power} / 2)) * pow(2.0D, {power} - floor({power} / 2))"
    )


def _digits(bins: str, sign: int) -> str:
    """Ascending digits (p, d) in base 2**BITS: the bins' limbs by place, with carries."""
    limbs = ", ".join(
        f"named_struct('p', x.bin + {i}, 's', {sign} * x.s{i})" for i in range(LIMBS)
    )

    def low(i: int) -> str:
        return f"named_struct('p', a.p + {i}, 'd', shiftright(a.c, {BITS * i}) & {MASK}L)"

    rest = f"named_struct('p', a.p + 2, 'd', shiftright(a.c, {2 * BITS}))"

    def moved(carry: str, *done: str) -> str:
        return f"named_struct('p', x.p, 'c', {carry}, 'd', concat(a.d, array({', '.join(done)})))"

    return (
        f"aggregate(array_sort(flatten(transform({bins}, x -> array({limbs})))),"
        " named_struct('p', -9L, 'c', 0L, 'd', cast(array() AS array<struct<p:bigint,d:bigint>>)),"
        " (a, x) -> CASE"
        " WHEN x.p = a.p THEN named_struct('p', x.p, 'c', a.c + x.s, 'd', a.d)"
        f" WHEN x.p = a.p + 1 THEN {moved(f'shiftright(a.c, {BITS}) + x.s', low(0))}"
        f" WHEN x.p = a.p + 2 THEN {moved(f'shiftright(a.c, {2 * BITS}) + x.s', low(0), low(1))}"
        f" ELSE {moved('x.s', low(0), low(1), rest)} END,"
        f" a -> filter(concat(a.d, array({low(0)}, {low(1)}, {rest})), x -> x.d <> 0))"
    )


def _signed(bins: str) -> str:
    """The value of several bins. A negative one is that of the opposite number, so no digits cancel."""

    def of(digits: str) -> str:
        top = f"element_at({digits}, -1).p"

        def two(first: int) -> str:
            return (
                f"aggregate({digits}, 0L, (a, x) -> a + CASE x.p WHEN {top} - {first} THEN"
                f" x.d * {1 << BITS}L WHEN {top} - {first + 1} THEN x.d ELSE 0L END)"
            )

        # What lies below the lowest digit taken only decides between two halves.
        below = f"aggregate({digits}, 0.0D, (a, x) -> CASE WHEN x.p < {top} - 3 THEN signum(x.d) / 2 ELSE a END)"
        return _scaled(two(0), f"({two(2)} + {below})", f"({top} - 3)")

    chosen = (
        f"CASE WHEN size(plus) = 0 THEN 0.0D WHEN element_at(plus, -1).d > 0 THEN {of('plus')}"
        f" ELSE -({of('minus')}) END"
    )
    return (
        f"transform(array({_digits(bins, 1)}), plus -> transform(array({_digits(bins, -1)}),"
        f" minus -> {chosen})[0])[0]"
    )
