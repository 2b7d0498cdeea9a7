"""Customer marts: segments and repeat purchases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.quantiles import cut_points, exact_quantiles
from starmill.operators.star import Tables, order_ids, star_join
from starmill.operators.sums import add_up, once, totals, with_limbs
from starmill.plans.common import PURCHASE, delivered, with_purchase
from starmill.plans.registry import mart
from starmill.session import stored

# Segment names, best first.
SEGMENTS = ("Champion", "Loyal", "Potential", "At Risk", "Lost")


@mart(
    sources="orders order_items customers order_payments",
    grain="customer_unique_id",
    columns="customer_unique_id string, recency_days int, frequency bigint,"
    " monetary double, rfm_segment string",
    positive=("frequency", "monetary"),
    between={"recency_days": (0, float("inf"))},
    in_set={"rfm_segment": SEGMENTS},
)
def customer_rfm_segments(
    t: Tables,
    quantiles: Sequence[float] = (0.2, 0.4, 0.6, 0.8),
    floors: Sequence[int] = (13, 10, 8, 6),
) -> DataFrame:
    """Recency, frequency and spending of each person over delivered orders.

    An order counts if it has a purchase time, lines and payments. Each of the three measures
    scores one point per quantile passed plus one; the sum of the points picks the segment by
    ``floors``. The people are stored, since the quantiles and the scores read them.
    """
    limbs = with_limbs(t["order_payments"], monetary="payment_value")
    paid = once(add_up(limbs, ["order_id"], ["monetary"]), ["order_id"], "monetary", "orders")
    bought = (
        star_join({**t, "orders": with_purchase(delivered(t["orders"]))}, ["orders", "customers"])
        .join(paid, "order_id")
        .join(order_ids(t["order_items"]), "order_id", "left_semi")
    )
    people = stored(
        totals(
            bought, ["customer_unique_id"], ["monetary"], {"frequency": F.sum("orders")},
            {"last_day": F.to_date(F.max(PURCHASE))},
        )
        .filter(F.col("monetary") > 0)
        # Days before the epoch day order people as recency does, without knowing the last day.
        .withColumn("age", -F.unix_date("last_day")),
        "rfm-people",
    )
    measures = ["age", "frequency", "monetary"]
    cuts = cut_points(exact_quantiles(people, measures, quantiles), measures, quantiles)
    today = people.agg(F.max("last_day")).scalar()

    def passed(column: str) -> Column:
        higher = [F.col(column) > F.col(f"cuts.{column}_{i}") for i in range(len(quantiles))]
        return sum((h.cast("int") for h in higher), F.lit(0))

    # A recent purchase scores high, so the quantiles it has not passed count.
    points = (
        (len(quantiles) + 1 - passed("age"))
        + (1 + passed("frequency"))
        + (1 + passed("monetary"))
    )
    segment = F.lit(SEGMENTS[-1])
    for name, floor in reversed(list(zip(SEGMENTS, floors))):
        segment = F.when(F.col("points") >= floor, name).otherwise(segment)
    return (
        people.withColumn("cuts", cuts)
        .withColumn("recency_days", F.datediff(today, F.col("last_day")))
        .withColumn("points", points)
        .withColumn("rfm_segment", segment)
    )


@mart(
    sources="orders customers",
    grain="customer_state",
    columns="customer_state string, repeat_rate double, customers bigint",
    between={"repeat_rate": (0, 1)},
)
def customer_repeat_rate(t: Tables) -> DataFrame:
    """Share of people with more than one order, by the state of their latest order."""
    people = (
        star_join(t, ["orders", "customers"])
        .groupBy("customer_unique_id")
        .agg(
            F.count("order_id").alias("n_orders"),
            F.max_by("customer_state", F.struct(PURCHASE, "order_id")).alias("customer_state"),
        )
    )
    return people.groupBy("customer_state").agg(
        F.avg(F.when(F.col("n_orders") > 1, 1).otherwise(0)).alias("repeat_rate"),
        F.count("*").alias("customers"),
    )
