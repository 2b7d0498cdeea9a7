"""Joins of the star schema.

Size-based broadcasting is left to Catalyst and AQE, which look at the size of a side before
they copy it; nothing here forces a broadcast. Where a side has many rows per key, the helpers
first reduce it to one row per key: the partial aggregate runs before the shuffle, so a hot key
reaches its task as a handful of rows, and the join reuses the aggregate's partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions import number
from starmill.operators.sums import totals, with_limbs

Tables = Mapping[str, DataFrame]

# table -> (tables that must be joined before it, join column, join kind), in join order.
JOIN_GRAPH: dict[str, tuple[tuple[str, ...], str, str]] = {
    "order_items": (("orders",), "order_id", "inner"),
    "order_payments": (("orders",), "order_id", "inner"),
    "order_reviews": (("orders",), "order_id", "inner"),
    "products": (("order_items",), "product_id", "inner"),
    "category_translation": (("products",), "product_category_name", "left"),
    "sellers": (("order_items",), "seller_id", "inner"),
    "customers": (("orders",), "customer_id", "inner"),
}
MANY_PER_ORDER = ("order_items", "order_payments", "order_reviews")


def star_join(tables: Tables, wanted: Iterable[str]) -> DataFrame:
    """Join the wanted tables along the join graph, in its order.

    The join starts at ``orders``, or at ``order_items`` if orders are not wanted. Asking for a
    table without the one it hangs on (translation without products, sellers without items) is
    an error, and so are two tables that both hold many rows per order: their product would
    count every amount several times.
    """
    wanted = set(wanted)
    unknown = wanted - set(JOIN_GRAPH) - {"orders"}
    if unknown:
        raise ValueError(f"no join path to {sorted(unknown)}")
    many = [t for t in MANY_PER_ORDER if t in wanted]
    if len(many) > 1:
        raise ValueError(f"{many} each hold many rows per order; reduce all but one first")
    root = "orders" if "orders" in wanted else "order_items"
    if root not in wanted:
        raise ValueError("a star join needs orders or order_items")
    joined = tables[root]
    for table, (parents, key, how) in JOIN_GRAPH.items():
        if table not in wanted or table == root:
            continue
        missing = [p for p in parents if p not in wanted]
        if missing:
            raise ValueError(f"{table} can only be joined after {missing}")
        joined = joined.join(tables[table], key, how)
    return joined


def translated(products: DataFrame, translation: DataFrame, how: str = "left") -> DataFrame:
    """Products with the English category name; a left join keeps the untranslated ones."""
    return products.join(translation, "product_category_name", how)


def per_order(lines: DataFrame, *measures: Column) -> DataFrame:
    """One row per order_id. Joining the result to orders needs no further shuffle."""
    return lines.groupBy("order_id").agg(*measures)


def order_ids(lines: DataFrame) -> DataFrame:
    return lines.select("order_id").distinct()


def distinct_orders(lines: DataFrame, orders: DataFrame, keys: list[str], alias: str) -> DataFrame:
    """Distinct known orders per group of line attributes or order attributes.

    Lines shrink to distinct (order, line attributes) pairs before they meet the orders, so an
    order with very many lines is a few rows by then. That costs a second, smaller shuffle
    where orders have few lines, and does not depend on AQE to split the hot order.
    """
    line_keys = [k for k in keys if k in lines.columns]
    pairs = lines.select("order_id", *line_keys).distinct()
    order_keys = [k for k in keys if k not in line_keys]
    if not order_keys:
        known = pairs.join(orders.select("order_id"), "order_id", "left_semi")
        return known.groupBy(*keys).agg(F.count("*").alias(alias))  # pairs are distinct
    # After this join the rows lie by order_id, which the distinct count uses as they are.
    joined = pairs.join(orders.select("order_id", *order_keys), "order_id")
    return joined.groupBy(*keys).agg(F.countDistinct("order_id").alias(alias))


def centroids(geolocation: DataFrame) -> DataFrame:
    """One row per zip prefix: the mean position of its many geolocation rows."""
    source = {"lat": "geolocation_lat", "lng": "geolocation_lng"}
    counts = {f"{name}_n": F.count(number(column)) for name, column in source.items()}
    zips = "geolocation_zip_code_prefix"
    sums = totals(with_limbs(geolocation, **source), [zips], list(source), counts)
    return sums.select(
        zips, *[(F.col(n) / F.nullif(f"{n}_n", F.lit(0))).alias(n) for n in source]
    )


def locate(df: DataFrame, geolocation: DataFrame, zip_column: str) -> DataFrame:
    """Add ``lat`` and ``lng`` of the zip prefix; rows without a known prefix keep nulls."""
    spots = centroids(geolocation).withColumnRenamed("geolocation_zip_code_prefix", zip_column)
    return df.join(spots, zip_column, "left")
