"""Raw tables derived from order-and-line warehouse tables (orders, lineitem, part, ...).

The marts need orders, items, payments, reviews and so on. A user whose data lies in the usual
TPC-H-like layout gets them from here as plain projections; only ``customers`` joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "part": "p_partkey bigint, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
        " l_quantity double, l_extendedprice double, l_tax double, l_returnflag string,"
        " l_linestatus string, l_shipdate timestamp"
    ),
    "events": "event_id bigint, ts timestamp, value double",
    "documents": "doc_id bigint, text string, source string",
}

# The category names that have a translation. PROMO has none.
TRANSLATED = ("STANDARD", "ECONOMY", "MEDIUM", "SMALL", "LARGE")


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One warehouse table; the declared schema saves the footer-reading job.

    Times without a zone are read as times of the session's zone, UTC by ``configure``.
    """
    return spark.read.schema(SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def orders(spark: SparkSession, folder: str) -> DataFrame:
    none = "CAST(NULL AS TIMESTAMP)"
    return read(spark, folder, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_orderkey AS customer_id",
        "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'"
        " ELSE 'canceled' END AS order_status",
        "o_orderdate AS order_purchase_timestamp",
        f"{none} AS order_approved_at",
        f"{none} AS order_delivered_carrier_date",
        "CASE WHEN o_orderkey % 37 != 0"
        " THEN o_orderdate + make_dt_interval(CAST(1 + o_orderkey % 40 AS INT)) END"
        " AS order_delivered_customer_date",
        "o_orderdate + INTERVAL '24' DAY AS order_estimated_delivery_date",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS order_item_id",
        "l_partkey AS product_id",
        "l_suppkey AS seller_id",
        "l_shipdate AS shipping_limit_date",
        "l_extendedprice AS price",
        "l_extendedprice * l_tax AS freight_value",
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "part").selectExpr(
        "p_partkey AS product_id",
        "CASE WHEN p_partkey % 50 != 0 THEN p_type END AS product_category_name",
        "p_size * 100 AS product_weight_g",
    )


def category_translation(spark: SparkSession, folder: str) -> DataFrame:
    rows = ", ".join(f"('{c}', '{c.lower()}')" for c in TRANSLATED)
    return spark.sql(
        f"SELECT * FROM VALUES {rows}"
        " AS t(product_category_name, product_category_name_english)"
    )


def _places(spark: SparkSession, folder: str) -> DataFrame:
    nation = read(spark, folder, "nation")
    region = read(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "n_nationkey", "n_name AS city", "r_name AS state"
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, as in the raw data; the person is ``customer_unique_id``."""
    people = read(spark, folder, "customer").join(
        _places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        read(spark, folder, "orders")
        .join(people, F.col("o_custkey") == F.col("c_custkey"))
        .selectExpr(
            "o_orderkey AS customer_id",
            "CASE WHEN o_orderkey % 4 = 0 THEN o_custkey ELSE 100000000 + o_orderkey END"
            " AS customer_unique_id",
            "c_nationkey AS customer_zip_code_prefix",
            "city AS customer_city",
            "state AS customer_state",
        )
    )


def sellers(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "supplier")
        .join(_places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr(
            "s_suppkey AS seller_id",
            "s_nationkey AS seller_zip_code_prefix",
            "city AS seller_city",
            "state AS seller_state",
        )
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per line."""
    return read(spark, folder, "lineitem").selectExpr(
        "l_orderkey AS order_id",
        "l_linenumber AS payment_sequential",
        "CASE WHEN l_returnflag = 'R' THEN 'credit_card' WHEN l_returnflag = 'A' THEN 'boleto'"
        " WHEN l_linestatus = 'O' THEN 'voucher' ELSE 'debit_card' END AS payment_type",
        "1 + CAST(floor(l_quantity) AS INT) % 12 AS payment_installments",
        "l_extendedprice * (1 + l_tax) AS payment_value",
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return read(spark, folder, "events").selectExpr(
        "event_id AS review_id",
        "event_id AS order_id",
        "1 + CAST(floor(value) AS INT) % 5 AS review_score",
        "ts AS review_creation_date",
    )


def geolocation(spark: SparkSession, folder: str) -> DataFrame:
    return (
        read(spark, folder, "nation")
        .select("n_nationkey", "n_name", F.explode(F.array(F.lit(10.0), F.lit(9.0))).alias("off"))
        .selectExpr(
            "n_nationkey AS geolocation_zip_code_prefix",
            "n_nationkey * 1.5D - off AS geolocation_lat",
            "n_nationkey * 1.5D - off AS geolocation_lng",
            "n_name AS geolocation_city",
        )
    )


_BUILDERS = {
    f.__name__: f
    for f in (
        orders, order_items, products, category_translation, customers, sellers,
        order_payments, order_reviews, geolocation,
    )
}


def bronze_tables(
    spark: SparkSession, folder: str, names: list[str] | None = None
) -> dict[str, DataFrame]:
    """The named raw tables, or all of them, by entity name."""
    return {n: _BUILDERS[n](spark, folder) for n in (names or _BUILDERS)}
