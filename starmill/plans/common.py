"""Pieces that several marts share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import number
from starmill.operators.star import Tables, star_join, translated
from starmill.operators.sums import add_up, with_limbs

PURCHASE = "order_purchase_timestamp"
CATEGORY = "product_category_name_english"
LINES = "orders order_items products category_translation"


def year(alias: str = "year"):
    return F.year(PURCHASE).alias(alias)


def month(alias: str = "month"):
    return F.month(PURCHASE).alias(alias)


def quarter(alias: str = "quarter"):
    return F.quarter(PURCHASE).alias(alias)


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("order_status") == "delivered")


def with_purchase(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col(PURCHASE).isNotNull())


def product_sums(t: Tables, *keys: Column) -> DataFrame:
    """Lines per (period, product), before any product attribute is joined.

    ``lines``: line items; ``priced``: those with a price; ``spent_*``: the sum of their prices, to
    be added up again.
    After the join of lines and orders only this much is shuffled by product, so neither a hot
    product nor a null category is ever a key at line grain.
    """
    lines = star_join(t, ["orders", "order_items"])
    counts = {"lines": F.count("*"), "priced": F.count(number("price"))}
    return add_up(with_limbs(lines, spent="price"), [*keys, "product_id"], ["spent"], counts)


def category_sums(t: Tables, *keys: Column, how: str = "left") -> DataFrame:
    """``product_sums`` with the products' attributes and translated category."""
    products = translated(t["products"], t["category_translation"], how)
    return product_sums(t, *keys).join(products, "product_id")


def item_categories(t: Tables, how: str = "left") -> DataFrame:
    """Items with their product's attributes and category; orders are not joined yet."""
    return t["order_items"].join(
        translated(t["products"], t["category_translation"], how), "product_id"
    )


def in_months(orders: DataFrame, years: Sequence[int], months: Sequence[int]) -> DataFrame:
    """Orders bought in the given months of the given years.

    The plain time range adds nothing to the result, but unlike ``year`` it reaches the scan,
    which skips the files and row groups outside of it.
    """
    bought = F.col(PURCHASE)
    first, after = (F.lit(f"{y:04d}-01-01").cast("timestamp") for y in (min(years), max(years) + 1))
    return orders.filter(
        (bought >= first)
        & (bought < after)
        & F.year(bought).isin(list(years))
        & F.month(bought).isin(list(months))
    )
