"""What must hold at any size: plan shapes, and joins whose hot key holds a third of the rows."""

import re

import pytest
from pyspark.sql import functions as F

import starmill
from conftest import rows
from starmill.operators import profiling

ROWS = 120_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A shop in which one order, one product and one seller hold a third of all lines."""
    root = str(tmp_path_factory.mktemp("skewed"))

    def store(df, name, files=6):
        df.repartition(files).write.parquet(f"{root}/{name}")
        return spark.read.parquet(f"{root}/{name}")

    hot = F.col("id") % 3 == 0
    n = F.col("id")
    return {
        "orders": store(spark.range(20_000).select(
            n.alias("order_id"), n.alias("customer_id"), F.lit("delivered").alias("order_status"),
            F.expr("timestamp'2017-01-01' + make_dt_interval(cast(id % 700 as int))")
            .alias("order_purchase_timestamp")), "orders"),
        "order_items": store(spark.range(ROWS).select(
            F.when(hot, 7).otherwise(n % 20_000).alias("order_id"),
            F.lit(1).alias("order_item_id"),
            F.when(hot, 5).otherwise(n % 3_000).alias("product_id"),
            F.when(hot, 3).otherwise(n % 50).alias("seller_id"),
            ((n % 1000) / 100).alias("price"), ((n % 77) / 100).alias("freight_value")), "items"),
        "products": store(spark.range(3_000).select(
            n.alias("product_id"), F.concat(F.lit("c"), n % 7).alias("product_category_name"),
            (n % 900).cast("int").alias("product_weight_g")), "products"),
        "category_translation": spark.range(6).select(
            F.concat(F.lit("c"), n).alias("product_category_name"),
            F.concat(F.lit("e"), n).alias("product_category_name_english")),
        "sellers": store(spark.range(50).select(
            n.alias("seller_id"), F.concat(F.lit("city"), n % 9).alias("seller_city"),
            F.concat(F.lit("st"), n % 4).alias("seller_state")), "sellers"),
        "customers": store(spark.range(20_000).select(
            n.alias("customer_id"), (n % 9_000).alias("customer_unique_id"),
            F.concat(F.lit("city"), n % 9).alias("customer_city"),
            F.concat(F.lit("st"), n % 4).alias("customer_state")), "customers"),
    }


# At this size everything would be broadcast and nothing would be worth splitting.
LARGE = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
    "spark__sql__shuffle__partitions": "16",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "4KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "4KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
}
JOINED_BY_LINE = ["monthly_revenue_summary", "yearly_average_revenue_by_category",
                  "monthly_average_revenue_by_product"]
REDUCED_FIRST = ["average_items_per_order_monthly", "quarterly_revenue_summary",
                 "freight_by_category", "avg_order_revenue_by_product_monthly",
                 "period_revenue_total", "order_basket_size"]
# These join products or sellers at line grain first; a hot one of those is left to AQE.
JOINED_FIRST = ["order_count_by_quarter", "order_count_by_seller_state",
                "order_count_by_state_and_category", "product_weight_summary_by_city"]


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def lines_are_aggregated_first(plan):
    """Going up from every scan of the line items, an aggregate comes before any exchange."""
    found = plan.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in found]
    scans = [i for i, line in enumerate(found) if "Scan" in line and "/items]" in line]
    for at in scans:
        level = depth[at]
        for i in range(at - 1, -1, -1):
            if depth[i] >= level:
                continue
            level = depth[i]
            if "HashAggregate" in found[i]:
                break
            if "Exchange hashpartitioning" in found[i]:
                return False
    return bool(scans)


@pytest.mark.parametrize("name", JOINED_BY_LINE)
def test_a_hot_key_is_split(skewed, conf, name):
    want = rows(starmill.build(name, skewed))
    conf(**LARGE)
    df = starmill.build(name, skewed)
    assert "skew=true" in final_plan(df)
    assert rows(df) == want


@pytest.mark.parametrize("name", REDUCED_FIRST)
def test_a_hot_key_is_reduced_before_it_is_shuffled(skewed, conf, name):
    want = rows(starmill.build(name, skewed))
    conf(**LARGE)
    df = starmill.build(name, skewed)
    plan = final_plan(df)
    assert rows(df) == want
    # The scan of the lines goes into an aggregate before any exchange, or the join was split.
    assert "skew=true" in plan or lines_are_aggregated_first(plan), plan


@pytest.mark.parametrize("name", JOINED_FIRST)
def test_skew_handling_does_not_change_results(skewed, conf, name):
    want = rows(starmill.build(name, skewed))
    conf(**LARGE)
    assert rows(starmill.build(name, skewed)) == want


def test_category_marts_aggregate_between_orders_and_products(skewed, conf):
    """Lines are summed per product after the join with orders and before that with products."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("monthly_revenue_summary", "yearly_average_revenue_by_category",
                 "order_count_by_quarter_product_category", "period_revenue_by_category",
                 "product_category_order_count_monthly"):
        plan = starmill.build(name, skewed)._jdf.queryExecution().executedPlan().toString()
        by_product = re.search(
            r"SortMergeJoin \[product_id.*?Exchange hashpartitioning\(product_id[^\n]*\n"
            r"(?:[^\n]*\n){0,6}?[^\n]*HashAggregate[^\n]*product_id.*?SortMergeJoin \[order_id",
            plan, re.DOTALL)
        assert by_product, (name, plan)


def test_scoped_marts_push_their_period(skewed, conf):
    conf(spark__sql__maxMetadataStringLength="1000")
    mart = starmill.build("monthly_revenue_summary", skewed, years=[1996, 1997], months=[1])
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp,1996-01-01" in plan


@pytest.mark.parametrize("name", starmill.mart_names())
def test_no_mart_multiplies_tables_or_runs_python(spark, shop, conf, name):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    plan = starmill.build(name, shop)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython"):
        assert bad not in plan, (name, bad)


def test_no_forced_broadcasts_of_tables(skewed, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    for name in ("monthly_revenue_summary", "order_count_by_seller_state", "freight_by_category"):
        plan = starmill.build(name, skewed)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastExchange" not in plan


def test_sums_are_combined_before_the_shuffle(skewed):
    plan = starmill.build("freight_by_category", skewed)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan


def test_scans_read_only_needed_columns(skewed):
    plan = starmill.build("order_count_by_seller_state", skewed)._jdf.queryExecution().executedPlan().toString()
    assert "struct<order_id:bigint,seller_id:bigint>" in plan
    assert "struct<seller_id:bigint,seller_state:string>" in plan


def test_periods_reach_the_scan(skewed, conf):
    conf(spark__sql__maxMetadataStringLength="1000")
    plan = starmill.build("period_revenue_total", skewed)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp,2016-01-01" in plan
    assert "LessThan(order_purchase_timestamp,2019-01-01" in plan


def test_top_values_are_cut_before_they_meet(skewed):
    top = profiling.profile_top_values(skewed["order_items"], ["order_id", "price"], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Partial", plan)


