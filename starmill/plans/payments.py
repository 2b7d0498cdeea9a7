"""Payment marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.star import Tables, order_ids, star_join
from starmill.operators.sums import add_up, once, totals, with_limbs
from starmill.plans.common import month, year
from starmill.plans.registry import mart

# The payment types that the acceptance rules allow.
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card")


def _paid_by_type(payments: DataFrame) -> DataFrame:
    """Sums per order and payment type, so that an order's many payments shuffle as few."""
    limbs = with_limbs(payments, payment_value="payment_value")
    return add_up(limbs, ["order_id", "payment_type"], ["payment_value"])


@mart(
    sources="orders order_payments",
    grain="payment_type year month",
    columns="payment_type string, year int, month int, average_installments double",
)
def average_installments_by_payment_type_monthly(t: Tables) -> DataFrame:
    """Orders without a purchase time form a null period."""
    paid = t["order_payments"].groupBy("order_id", "payment_type").agg(
        F.sum("payment_installments").alias("installments"),
        F.count("payment_installments").alias("n"),
    )
    return (
        paid.join(t["orders"], "order_id")
        .groupBy("payment_type", year(), month())
        .agg((F.sum("installments") / F.nullif(F.sum("n"), F.lit(0))).alias("average_installments"))
    )


@mart(
    sources="order_payments",
    grain="payment_type",
    columns="payment_type string, average_installments double, payment_value double",
    between={"average_installments": (1, float("inf"))},
)
def installments_by_payment_type(t: Tables) -> DataFrame:
    limbs = with_limbs(t["order_payments"], payment_value="payment_value")
    parts = "payment_installments"
    counts = {"parts": F.sum(parts), "n": F.count(parts)}
    return totals(limbs, ["payment_type"], ["payment_value"], counts).select(
        "payment_type",
        (F.col("parts") / F.nullif("n", F.lit(0))).alias("average_installments"),
        "payment_value",
    )


@mart(
    sources="orders customers order_payments",
    grain="customer_state payment_type",
    columns="customer_state string, payment_type string, payment_value double,"
    " order_count bigint",
    positive=("payment_value",),
    in_set={"payment_type": PAYMENT_TYPES},
)
def payment_mix_by_state(t: Tables) -> DataFrame:
    paid = _paid_by_type(t["order_payments"])
    pairs = once(paid, ["order_id", "payment_type"], "payment_value", "order_count")
    known = pairs.join(star_join(t, ["orders", "customers"]), "order_id")
    keys, counts = ["customer_state", "payment_type"], {"order_count": F.sum("order_count")}
    return totals(known, keys, ["payment_value"], counts)


@mart(
    sources="orders order_payments order_items",
    grain="order_year order_month payment_type",
    columns="order_year int, order_month int, payment_type string, payment_value double",
    positive=("payment_value",),
    between={"order_month": (1, 12)},
)
def monthly_revenue_by_payment_type(t: Tables) -> DataFrame:
    """Each payment counts once; items only prove that the order has lines."""
    paid = (
        _paid_by_type(t["order_payments"])
        .join(t["orders"], "order_id")
        .join(order_ids(t["order_items"]), "order_id", "left_semi")
    )
    keys = [year("order_year"), month("order_month"), "payment_type"]
    return totals(paid, keys, ["payment_value"])
