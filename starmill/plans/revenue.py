"""Revenue marts.

Two families live side by side. Some marts keep a known quirk of the jobs they stand in for
(they count line items, or multiply by the line number); their intended forms have names of
their own. Neither is silently replaced by the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.star import Tables, star_join
from starmill.operators.sums import add_up, once, totals, with_limbs
from starmill.plans.common import (
    CATEGORY,
    LINES,
    category_sums,
    delivered,
    in_months,
    item_categories,
    month,
    quarter,
    with_purchase,
    year,
)
from starmill.plans.registry import mart

# The period that the first-quarter stories ask for.
YEARS = (2016, 2017, 2018)
FIRST_QUARTER = (1, 2, 3)


@mart(
    sources=LINES,
    grain=f"order_year order_month {CATEGORY}",
    columns=f"order_year int, order_month int, {CATEGORY} string,"
    " total_revenue double, total_orders bigint, avg_order_value double",
    positive=("total_revenue",),
    not_null=(CATEGORY,),
    between={"order_month": (1, 12)},
)
def monthly_revenue_summary(
    t: Tables, years: Sequence[int] | None = None, months: Sequence[int] | None = None
) -> DataFrame:
    """Delivered revenue per month and category. Literal: orders and averages count line items.

    With ``years`` and ``months`` only those periods are read and computed.
    """
    orders = with_purchase(delivered(t["orders"]))
    if years is not None and months is not None:
        orders = in_months(orders, years, months)
    items = t["order_items"].filter(F.col("price").isNotNull())
    wanted = {**t, "orders": orders, "order_items": items}
    sums = category_sums(wanted, year("order_year"), month("order_month")).filter(
        F.col(CATEGORY).isNotNull()
    )
    keys = ["order_year", "order_month", CATEGORY]
    counts = {"lines": F.sum("lines"), "priced": F.sum("priced")}
    return totals(sums, keys, ["spent"], counts).select(
        *keys,
        F.col("spent").alias("total_revenue"),
        F.col("lines").alias("total_orders"),
        (F.col("spent") / F.nullif("priced", F.lit(0))).alias("avg_order_value"),
    )


@mart(
    sources=LINES,
    grain=f"order_year order_month {CATEGORY}",
    columns=f"order_year int, order_month int, {CATEGORY} string,"
    " total_revenue double, total_orders bigint, avg_order_value double",
    positive=("total_revenue",),
    not_null=(CATEGORY,),
    between={"order_month": (1, 12)},
)
def monthly_revenue_distinct_orders(t: Tables) -> DataFrame:
    """The intended form of the monthly summary: distinct orders, revenue per order."""
    lines = item_categories(t).filter(F.col("price").isNotNull() & F.col(CATEGORY).isNotNull())
    pairs = ["order_id", CATEGORY]
    spent = once(add_up(with_limbs(lines, spent="price"), pairs, ["spent"]), pairs, "spent", "orders")
    known = spent.join(with_purchase(delivered(t["orders"])), "order_id")
    keys = [year("order_year"), month("order_month"), CATEGORY]
    return totals(known, keys, ["spent"], {"orders": F.sum("orders")}).select(
        "order_year", "order_month", CATEGORY,
        F.col("spent").alias("total_revenue"),
        F.col("orders").alias("total_orders"),
        (F.col("spent") / F.nullif("orders", F.lit(0))).alias("avg_order_value"),
    )


@mart(
    sources="orders order_items",
    grain="year month product_id",
    columns="year int, month int, product_id string, total_revenue double",
    not_null=("product_id",),
    between={"month": (1, 12)},
)
def monthly_average_revenue_by_product(t: Tables) -> DataFrame:
    """Literal: the sum of prices per product and month, despite the name."""
    lines = star_join({**t, "orders": delivered(t["orders"])}, ["orders", "order_items"])
    priced = with_limbs(lines, total_revenue="price")
    return totals(priced, [year(), month(), "product_id"], ["total_revenue"])


@mart(
    sources="orders order_items",
    grain="year month product_id",
    columns="year int, month int, product_id string, average_revenue double",
    not_null=("product_id",),
    between={"month": (1, 12)},
)
def avg_order_revenue_by_product_monthly(t: Tables) -> DataFrame:
    """Per product and month, the mean over orders of what the order spent on the product."""
    pairs = ["order_id", "product_id"]
    spent = add_up(with_limbs(t["order_items"], spent="price"), pairs, ["spent"])
    known = once(spent, pairs, "spent", "orders").join(delivered(t["orders"]), "order_id")
    priced = F.count_if((F.col("orders") == 1) & F.col("spent_bin").isNotNull())
    sums = totals(known, [year(), month(), "product_id"], ["spent"], {"orders": priced})
    return sums.select(
        "year", "month", "product_id",
        (F.col("spent") / F.nullif("orders", F.lit(0))).alias("average_revenue"),
    )


@mart(
    sources="orders order_items",
    grain="year month",
    columns="year int, month int, revenue double",
    positive=("revenue",),
    between={"month": (1, 12)},
)
def quarterly_revenue_summary(t: Tables) -> DataFrame:
    """Literal: grouped by month, and the price is multiplied by the line's sequence number."""
    return _by_period(t, F.col("price") * F.col("order_item_id"), year(), month())


@mart(
    sources="orders order_items",
    grain="year quarter",
    columns="year int, quarter int, revenue double",
    positive=("revenue",),
    between={"quarter": (1, 4)},
)
def quarterly_revenue_by_quarter(t: Tables) -> DataFrame:
    """The intended form: delivered revenue per calendar quarter."""
    return _by_period(t, F.col("price"), year(), quarter())


def _by_period(t: Tables, amount: Column, *period: Column) -> DataFrame:
    spent = add_up(with_limbs(t["order_items"], revenue=amount), ["order_id"], ["revenue"])
    return totals(spent.join(delivered(t["orders"]), "order_id"), period, ["revenue"])


@mart(
    sources=LINES,
    grain=f"{CATEGORY} year",
    columns=f"{CATEGORY} string, year int, average_revenue double",
)
def yearly_average_revenue_by_category(t: Tables) -> DataFrame:
    """Mean price of delivered lines; untranslated categories form a null group."""
    sums = category_sums({**t, "orders": delivered(t["orders"])}, year())
    return totals(sums, [CATEGORY, "year"], ["spent"], {"priced": F.sum("priced")}).select(
        CATEGORY, "year",
        (F.col("spent") / F.nullif("priced", F.lit(0))).alias("average_revenue"),
    )


@mart(
    sources="orders order_items",
    grain="year month product_id",
    columns="year int, month int, product_id string, total_revenue double",
    between={"month": (1, 3)},
)
def period_revenue_by_product(
    t: Tables, years: Sequence[int] = YEARS, months: Sequence[int] = FIRST_QUARTER
) -> DataFrame:
    """Revenue per product and month inside the wanted months of the wanted years."""
    wanted = {**t, "orders": in_months(t["orders"], years, months)}
    lines = with_limbs(star_join(wanted, ["orders", "order_items"]), total_revenue="price")
    return totals(lines, [year(), month(), "product_id"], ["total_revenue"])


@mart(
    sources="orders order_items",
    grain="year month",
    columns="year int, month int, total_revenue double",
    positive=("total_revenue",),
    between={"month": (1, 3)},
)
def period_revenue_total(
    t: Tables, years: Sequence[int] = YEARS, months: Sequence[int] = FIRST_QUARTER
) -> DataFrame:
    """Revenue per month. Payments are not joined: they would multiply the lines."""
    lines = with_limbs(t["order_items"], total_revenue="price")
    spent = add_up(lines, ["order_id"], ["total_revenue"])
    known = spent.join(in_months(t["orders"], years, months), "order_id")
    return totals(known, [year(), month()], ["total_revenue"])


@mart(
    sources=LINES,
    grain=f"year month {CATEGORY}",
    columns=f"year int, month int, {CATEGORY} string, total_revenue double",
    between={"month": (1, 3)},
)
def period_revenue_by_category(
    t: Tables, years: Sequence[int] = YEARS, months: Sequence[int] = FIRST_QUARTER
) -> DataFrame:
    """Revenue per month and category; the sum is over prices, not over repeated payments."""
    wanted = {**t, "orders": in_months(t["orders"], years, months)}
    return totals(
        category_sums(wanted, year(), month()), ["year", "month", CATEGORY], ["spent"]
    ).withColumnRenamed("spent", "total_revenue")
