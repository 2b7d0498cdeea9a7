import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

import starmill  # noqa: E402

TESTDATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("scratch")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield starmill.configure(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    saved = {}

    def change(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            saved.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in saved.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def shop(spark):
    """A tiny shop with every awkward case that the marts must get right.

    o1: two lines of one product, two payments, two reviews.  o2: canceled.  o3: null purchase
    time.  o4: untranslated and null categories, delivered before it was bought.  o5: no items.
    Line x belongs to no order; the price of one line of o4 is null.
    """

    def table(schema, *rows):
        return spark.createDataFrame(list(rows), schema)

    stamp = "cast(b as timestamp) order_purchase_timestamp"
    orders = table(
        "order_id string, customer_id string, order_status string, b string, d string, e string",
        ("o1", "c1", "delivered", "2017-01-10 08:00:00", "2017-01-15 07:00:00", "2017-01-14 00:00:00"),
        ("o2", "c2", "canceled", "2017-02-01 00:00:00", None, "2017-02-20 00:00:00"),
        ("o3", "c3", "delivered", None, None, None),
        ("o4", "c4", "delivered", "2018-03-05 00:00:00", "2018-03-01 00:00:00", "2018-03-20 00:00:00"),
        ("o5", "c5", "delivered", "2018-04-01 00:00:00", "2018-04-05 00:00:00", "2018-04-20 00:00:00"),
    ).selectExpr(
        "order_id", "customer_id", "order_status", stamp,
        "cast(d as timestamp) order_delivered_customer_date",
        "cast(e as timestamp) order_estimated_delivery_date",
    )
    return {
        "orders": orders,
        "order_items": table(
            "order_id string, order_item_id int, product_id string, seller_id string,"
            " price double, freight_value double",
            ("o1", 1, "p1", "s1", 10.10, 1.0),
            ("o1", 2, "p1", "s2", 20.20, 2.0),
            ("o2", 1, "p1", "s1", 5.0, 3.0),
            ("o3", 1, "p1", "s1", 7.0, 4.0),
            ("o4", 1, "p2", "s1", 8.0, 5.0),
            ("o4", 2, "p3", "s1", 9.0, 6.0),
            ("o4", 3, "p1", "s1", None, 7.0),
            ("x", 1, "p1", "s1", 1000.0, 8.0),
            ("o1", 3, "nope", "s1", 500.0, 9.0),
        ),
        "products": table(
            "product_id string, product_category_name string, product_weight_g int",
            ("p1", "brinquedos", 100), ("p2", "promo", 200), ("p3", None, None),
        ),
        "category_translation": table(
            "product_category_name string, product_category_name_english string",
            ("brinquedos", "toys"),
        ),
        "customers": table(
            "customer_id string, customer_unique_id string, customer_zip_code_prefix int,"
            " customer_city string, customer_state string",
            ("c1", "u1", 100, "sao paulo", "SP"),
            ("c2", "u1", 100, "sao paulo", "SP"),
            ("c3", "u2", 200, "rio", "RJ"),
            ("c4", "u1", 200, "rio", "RJ"),
            ("c5", "u3", 300, "recife", "PE"),
        ),
        "sellers": table(
            "seller_id string, seller_city string, seller_state string",
            ("s1", "campinas", "SP"), ("s2", "rio", "RJ"),
        ),
        "order_payments": table(
            "order_id string, payment_sequential int, payment_type string,"
            " payment_installments int, payment_value double",
            ("o1", 1, "credit_card", 3, 25.0),
            ("o1", 2, "voucher", 1, 5.30),
            ("o3", 1, "boleto", 1, 7.0),
            ("o4", 1, "credit_card", 5, 17.0),
            ("o5", 1, "boleto", 1, 99.0),
        ),
        "order_reviews": table(
            "review_id string, order_id string, review_score int, w string",
            ("r1", "o1", 5, "2017-01-18 10:00:00"),
            ("r2", "o1", 4, "2017-01-16 00:00:00"),
            ("r3", "o2", 1, "2017-02-05 23:59:59"),
            ("r4", "gone", 3, "2017-02-05 00:00:00"),
        ).selectExpr("review_id", "order_id", "review_score", "cast(w as timestamp) review_creation_date"),
        "geolocation": table(
            "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double",
            (100, -23.5, -46.5), (100, -23.7, -46.7), (200, -22.9, -43.2),
        ),
    }


def rows(df, *keys):
    """Rows as tuples, sorted; nulls first."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))
