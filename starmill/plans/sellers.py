"""Seller scorecard and review marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.operators.star import Tables, per_order
from starmill.operators.sums import add_up, once, totals, with_limbs
from starmill.plans.registry import mart

TIERS = ("Gold", "Silver", "Bronze")


@mart(
    sources="orders order_items order_reviews sellers",
    grain="seller_id",
    columns="seller_id string, avg_review_score double, total_revenue double,"
    " cancellation_rate double, performance_tier string",
    not_null=("performance_tier",),
    between={"cancellation_rate": (0, 1)},
    in_set={"performance_tier": TIERS},
)
def seller_performance_scorecard(
    t: Tables,
    gold_score: float = 4.0,
    gold_cancel: float = 0.05,
    silver_score: float = 3.0,
) -> DataFrame:
    """Review score, revenue and cancellations per seller.

    Every order of a seller weighs once: its reviews are one mean score and its lines one sum,
    so that neither multiplies the other. Sellers without reviews are Bronze.
    """
    scores = per_order(t["order_reviews"], F.avg("review_score").alias("score"))
    pairs = ["order_id", "seller_id"]
    lines = with_limbs(t["order_items"], total_revenue="price")
    sold = add_up(lines, pairs, ["total_revenue"])
    known = (
        once(sold, pairs, "total_revenue", "first")
        .join(t["orders"].select("order_id", "order_status"), "order_id")
        .join(scores, "order_id", "left")
    )
    first = F.col("first") == 1
    scored = with_limbs(known, score=F.when(first, F.col("score")))
    counts = {
        "orders": F.sum("first"),
        "scored": F.count("score_bin"),
        "canceled": F.count_if(first & (F.col("order_status") == "canceled")),
    }
    sums = totals(scored, ["seller_id"], ["score", "total_revenue"], counts)
    sales = sums.select(
        "seller_id",
        (F.col("score") / F.nullif("scored", F.lit(0))).alias("avg_review_score"),
        "total_revenue",
        (F.col("canceled") / F.col("orders")).alias("cancellation_rate"),
    )
    tier = (
        F.when(
            (F.col("avg_review_score") >= gold_score)
            & (F.col("cancellation_rate") <= gold_cancel),
            "Gold",
        )
        .when(F.col("avg_review_score") >= silver_score, "Silver")
        .otherwise("Bronze")
    )
    return sales.join(t["sellers"].select("seller_id"), "seller_id").withColumn(
        "performance_tier", tier
    )


@mart(
    sources="orders order_reviews",
    grain="review_week review_score",
    columns="review_week date, review_score int, weekly_review_count bigint",
    between={"review_score": (1, 5)},
)
def weekly_review_distribution(t: Tables) -> DataFrame:
    """Reviews of known orders per week (from Monday) and score."""
    week = F.to_date(F.date_trunc("week", "review_creation_date")).alias("review_week")
    given = t["order_reviews"].groupBy("order_id", week, "review_score").agg(
        F.count("*").alias("n")
    )
    return (
        given.join(t["orders"].select("order_id"), "order_id")
        .groupBy("review_week", "review_score")
        .agg(F.sum("n").alias("weekly_review_count"))
    )
