"""Order counts, baskets, freight and delivery marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import days_between, number
from starmill.operators.quantiles import cut_points, exact_quantiles
from starmill.operators.star import Tables, distinct_orders, per_order, star_join, translated
from starmill.operators.sums import add_up, totals, with_limbs
from starmill.plans.common import (
    CATEGORY,
    LINES,
    PURCHASE,
    category_sums,
    delivered,
    item_categories,
    month,
    quarter,
    with_purchase,
    year,
)
from starmill.plans.registry import mart
from starmill.session import stored


@mart(
    sources=LINES,
    grain=f"order_year order_quarter {CATEGORY}",
    columns=f"order_year int, order_quarter int, {CATEGORY} string, order_count bigint",
    positive=("order_count",),
    not_null=(CATEGORY,),
    between={"order_quarter": (1, 4)},
)
def order_count_by_quarter(t: Tables) -> DataFrame:
    """Distinct orders per quarter and translated category."""
    lines = item_categories(t).filter(F.col(CATEGORY).isNotNull())
    orders = with_purchase(t["orders"]).select(
        "order_id", year("order_year"), quarter("order_quarter")
    )
    return distinct_orders(lines, orders, ["order_year", "order_quarter", CATEGORY], "order_count")


@mart(
    sources=LINES,
    grain=f"order_year order_quarter {CATEGORY}",
    columns=f"order_year int, order_quarter int, {CATEGORY} string, order_count bigint",
    positive=("order_count",),
)
def order_count_by_quarter_product_category(t: Tables) -> DataFrame:
    """Line items (not orders) per quarter and category; null periods and categories are kept."""
    return (
        category_sums(t, year("order_year"), quarter("order_quarter"))
        .groupBy("order_year", "order_quarter", CATEGORY)
        .agg(F.sum("lines").alias("order_count"))
    )


@mart(
    sources="orders order_items sellers",
    grain="seller_state",
    columns="seller_state string, total_orders bigint",
    positive=("total_orders",),
)
def order_count_by_seller_state(t: Tables) -> DataFrame:
    lines = star_join(t, ["order_items", "sellers"])
    return distinct_orders(lines, t["orders"], ["seller_state"], "total_orders")


@mart(
    sources="orders order_items sellers",
    grain="seller_state seller_city",
    columns="seller_state string, seller_city string, total_orders bigint",
    positive=("total_orders",),
)
def order_count_by_seller_state_city(t: Tables) -> DataFrame:
    lines = star_join(t, ["order_items", "sellers"])
    return distinct_orders(lines, t["orders"], ["seller_state", "seller_city"], "total_orders")


@mart(
    sources="orders order_items products category_translation sellers",
    grain=f"seller_city {CATEGORY}",
    columns=f"seller_city string, {CATEGORY} string, total_order_count bigint",
    positive=("total_order_count",),
)
def order_count_by_seller_city_and_category(t: Tables) -> DataFrame:
    """Distinct orders per seller city and category; untranslated ones form a null group."""
    lines = star_join(t, ["order_items", "products", "category_translation", "sellers"])
    return distinct_orders(lines, t["orders"], ["seller_city", CATEGORY], "total_order_count")


@mart(
    sources=f"{LINES} customers",
    grain=f"customer_state {CATEGORY}",
    columns=f"customer_state string, {CATEGORY} string, order_count bigint",
    positive=("order_count",),
)
def order_count_by_state_and_category(t: Tables) -> DataFrame:
    """Distinct orders per customer state and category; untranslated ones form a null group."""
    orders = star_join(t, ["orders", "customers"])
    lines = item_categories(t)
    return distinct_orders(lines, orders, ["customer_state", CATEGORY], "order_count")


@mart(
    sources="orders order_items products category_translation",
    grain="product_category_name order_month",
    columns="product_category_name string, order_month int, order_count bigint",
    positive=("order_count",),
)
def product_category_order_count_monthly(t: Tables) -> DataFrame:
    """Line items per category and calendar month, over all years; translated categories only."""
    lines = star_join(t, ["orders", "order_items"]).groupBy(month("order_month"), "product_id").agg(
        F.count("*").alias("lines")
    )
    return (
        lines.join(translated(t["products"], t["category_translation"], "inner"), "product_id")
        .groupBy("product_category_name", "order_month")
        .agg(F.sum("lines").alias("order_count"))
    )


@mart(
    sources="orders order_items products category_translation",
    grain="product_category_name",
    columns="product_category_name string, "
    + ", ".join(f"month_{m} bigint" for m in range(1, 13)),
)
def category_month_pivot(t: Tables) -> DataFrame:
    """The monthly category counts with months as columns; empty cells are zero."""
    wide = (
        product_category_order_count_monthly(t)
        .groupBy("product_category_name")
        .pivot("order_month", list(range(1, 13)))
        .agg(F.sum("order_count"))
        .fillna(0)
    )
    return wide.withColumnsRenamed({str(m): f"month_{m}" for m in range(1, 13)})


@mart(
    sources="orders order_items",
    grain="order_year order_month",
    columns="order_year int, order_month int, average_items_per_order double",
    between={"order_month": (1, 12)},
)
def average_items_per_order_monthly(t: Tables) -> DataFrame:
    items = per_order(t["order_items"], F.count("order_item_id").alias("items"))
    return (
        items.join(t["orders"], "order_id")
        .groupBy(year("order_year"), month("order_month"))
        .agg(F.avg("items").alias("average_items_per_order"))
    )


@mart(
    sources="order_items",
    grain="",
    columns="avg_items_per_order double, max_items_per_order bigint",
    positive=("max_items_per_order",),
)
def order_basket_size(t: Tables) -> DataFrame:
    """Mean and largest number of lines per order, one row."""
    return order_basket_detail(t).agg(
        F.avg("basket_size").alias("avg_items_per_order"),
        F.max("basket_size").alias("max_items_per_order"),
    )


@mart(
    sources="order_items",
    grain="order_id",
    columns="order_id string, basket_size bigint",
    positive=("basket_size",),
)
def order_basket_detail(t: Tables) -> DataFrame:
    return per_order(t["order_items"], F.count("*").alias("basket_size"))


def _per_product(items: DataFrame, *columns: str, keys: Sequence[str] = ("product_id",)) -> DataFrame:
    """Sum and count of each column per product, before any product attribute is joined."""
    counts = {f"{c}_n": F.count(number(c)) for c in columns}
    return add_up(with_limbs(items, **{c: c for c in columns}), keys, columns, counts)


def _means(sums: DataFrame, key: str, **means: str) -> DataFrame:
    """Per ``key``, each mean of a column of ``_per_product`` under its name."""
    columns = list(means.values())
    found = totals(sums, [key], columns, {f"{c}_n": F.sum(f"{c}_n") for c in columns})
    return found.select(
        key, *[(F.col(c) / F.nullif(f"{c}_n", F.lit(0))).alias(n) for n, c in means.items()]
    )


@mart(
    sources="order_items products",
    grain="product_category_name",
    columns="product_category_name string, avg_freight_cost double",
    positive=("avg_freight_cost",),
)
def average_freight_cost_by_category(t: Tables) -> DataFrame:
    """Mean freight per untranslated category name; products without one form a null group."""
    sums = _per_product(t["order_items"], "freight_value").join(t["products"], "product_id")
    return _means(sums, "product_category_name", avg_freight_cost="freight_value")


@mart(
    sources="order_items products orders customers",
    grain="product_category_name",
    columns="product_category_name string, avg_freight_cost double",
)
def freight_by_category_filtered(
    t: Tables,
    start: str | None = None,
    end: str | None = None,
    states: list[str] | None = None,
) -> DataFrame:
    """The freight mart over purchases in [start, end) by customers of the given states."""
    orders = t["orders"]
    if start is not None:
        orders = orders.filter(F.col(PURCHASE) >= F.lit(start).cast("timestamp"))
    if end is not None:
        orders = orders.filter(F.col(PURCHASE) < F.lit(end).cast("timestamp"))
    customers = t["customers"]
    if states is not None:
        customers = customers.filter(F.col("customer_state").isin(list(states)))
    chosen = star_join({**t, "orders": orders, "customers": customers}, ["orders", "customers"])
    pairs = _per_product(t["order_items"], "freight_value", keys=["order_id", "product_id"])
    known = pairs.join(chosen.select("order_id"), "order_id")
    sums = add_up(known, ["product_id"], ["freight_value"], {"freight_value_n": F.sum("freight_value_n")})
    return _means(
        sums.join(t["products"], "product_id"), "product_category_name",
        avg_freight_cost="freight_value",
    )


@mart(
    sources="order_items products category_translation",
    grain=CATEGORY,
    columns=f"{CATEGORY} string, avg_freight_value double, avg_price double",
)
def freight_by_category(t: Tables) -> DataFrame:
    """Mean freight and price per English category; untranslated ones form a null group."""
    sums = _per_product(t["order_items"], "freight_value", "price").join(
        translated(t["products"], t["category_translation"]), "product_id"
    )
    return _means(sums, CATEGORY, avg_freight_value="freight_value", avg_price="price")


@mart(
    sources="orders order_items products customers",
    grain="customer_city",
    columns="customer_city string, total_weight bigint",
    target="product_weight_per_city",
)
def product_weight_summary_by_city(t: Tables) -> DataFrame:
    """Weight shipped to each city; a product weighs once per line item."""
    weights = t["order_items"].join(t["products"], "product_id")
    return (
        per_order(weights, F.sum("product_weight_g").alias("weight"))
        .join(star_join(t, ["orders", "customers"]), "order_id")
        .groupBy("customer_city")
        .agg(F.sum("weight").alias("total_weight"))
    )


def _latency(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_delivered_customer_date").isNotNull()).select(
        "order_id",
        days_between("order_delivered_customer_date", PURCHASE).alias("delivery_days"),
        (
            F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date")
        ).alias("is_late"),
    )


@mart(
    sources="orders",
    grain="order_id",
    columns="order_id string, delivery_days int, is_late boolean",
    between={"delivery_days": (0, float("inf"))},
)
def order_delivery_sla(t: Tables) -> DataFrame:
    """Days from purchase to delivery, for every order with a delivery date."""
    return _latency(t["orders"])


@mart(
    sources="orders customers",
    grain="order_id",
    columns="order_id string, delivery_days int, is_late boolean",
    between={"delivery_days": (0, float("inf"))},
)
def sp_delivery_delays(t: Tables, state: str = "SP") -> DataFrame:
    """Delivery days of delivered orders in one state; negative spans are dropped."""
    local = t["customers"].filter(F.col("customer_state") == state)
    chosen = {"orders": delivered(t["orders"]), "customers": local}
    orders = star_join(chosen, ["orders", "customers"])
    return _latency(orders).filter(F.col("delivery_days") >= 0)


@mart(
    sources="order_items products",
    grain="",
    columns="product_id string, price double, product_weight_g int,"
    " price_outlier boolean, weight_outlier boolean",
    positive=("price",),
    not_null=("product_id",),
)
def product_price_weight_flags(t: Tables, percentile: float = 0.95) -> DataFrame:
    """Line items whose price or product weight lies above the given percentile.

    The joined lines are stored, since the percentiles and the flags read them.
    """
    lines = stored(
        t["order_items"].join(t["products"], "product_id").select(
            "product_id", "price", "product_weight_g"
        ),
        "flag-lines",
    )
    flagged = ["price", "product_weight_g"]
    cuts = cut_points(exact_quantiles(lines, flagged, [percentile]), flagged, [percentile])

    def above(column: str) -> Column:
        return F.coalesce(F.col(column) > F.col(f"cuts.{column}_0"), F.lit(False))

    return lines.withColumn("cuts", cuts).withColumns(
        {"price_outlier": above("price"), "weight_outlier": above("product_weight_g")}
    )
