"""The marts on a tiny shop whose results are worked out by hand."""

import datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import starmill
from conftest import rows
from starmill.operators import star


def build(shop, name, **args):
    return rows(starmill.build(name, shop, **args))


def test_columns_and_types_are_as_declared(shop):
    for name in starmill.mart_names():
        assert dict(starmill.build(name, shop).dtypes) == dict(starmill.spec(name).columns), name


def test_raw_table_names_are_accepted(shop):
    raw = {f"olist_{k}_raw": v for k, v in shop.items()}
    assert build(raw, "order_count_by_seller_state") == build(shop, "order_count_by_seller_state")


def test_missing_table_is_refused(shop):
    with pytest.raises(KeyError, match="order_items"):
        starmill.build("monthly_revenue_summary", {"orders": shop["orders"]})


def test_missing_column_fails_at_analysis(shop):
    broken = {**shop, "order_items": shop["order_items"].drop("price")}
    with pytest.raises(AnalysisException):
        starmill.build("monthly_revenue_summary", broken)


def test_monthly_summary_counts_lines_and_its_intended_form_counts_orders(shop):
    assert build(shop, "monthly_revenue_summary") == [
        (2017, 1, "toys", pytest.approx(30.30), 2, pytest.approx(15.15))
    ]
    assert build(shop, "monthly_revenue_distinct_orders") == [
        (2017, 1, "toys", pytest.approx(30.30), 1, pytest.approx(30.30))
    ]


def test_order_counts_by_quarter(shop):
    assert build(shop, "order_count_by_quarter") == [
        (2017, 1, "toys", 2), (2018, 1, "toys", 1)
    ]
    assert build(shop, "order_count_by_quarter_product_category") == [
        (None, None, "toys", 1),
        (2017, 1, "toys", 3),
        (2018, 1, None, 2),
        (2018, 1, "toys", 1),
    ]


def test_order_counts_by_place(shop):
    # The orphan line is dropped; the line of an unknown product still counts for its seller.
    assert build(shop, "order_count_by_seller_state") == [("RJ", 1), ("SP", 4)]
    assert build(shop, "order_count_by_seller_state_city") == [
        ("RJ", "rio", 1), ("SP", "campinas", 4)
    ]
    assert build(shop, "order_count_by_seller_city_and_category") == [
        ("campinas", None, 1), ("campinas", "toys", 4), ("rio", "toys", 1)
    ]
    assert build(shop, "order_count_by_state_and_category") == [
        ("RJ", None, 1), ("RJ", "toys", 2), ("SP", "toys", 2)
    ]


def test_duplicate_lines_do_not_change_distinct_orders(shop):
    twice = {**shop, "order_items": shop["order_items"].union(shop["order_items"])}
    for name in ("order_count_by_quarter", "order_count_by_seller_state",
                 "order_count_by_state_and_category"):
        assert build(twice, name) == build(shop, name)


def test_freight(shop):
    assert build(shop, "average_freight_cost_by_category") == [
        (None, 6.0), ("brinquedos", pytest.approx((1 + 2 + 3 + 4 + 7 + 8) / 6)), ("promo", 5.0)
    ]
    assert build(shop, "freight_by_category") == [
        (None, 5.5, 8.5),
        ("toys", pytest.approx(25 / 6), pytest.approx((10.1 + 20.2 + 5 + 7 + 1000) / 5)),
    ]


def test_freight_filters_are_optional_and_half_open(shop):
    everything = build(shop, "freight_by_category_filtered")
    assert everything == [(None, 6.0), ("brinquedos", pytest.approx(17 / 5)), ("promo", 5.0)]
    some = build(shop, "freight_by_category_filtered",
                 start="2017-01-01", end="2017-02-01", states=["SP"])
    assert some == [("brinquedos", 1.5)]


def test_items_per_order(shop):
    assert build(shop, "average_items_per_order_monthly") == [
        (None, None, 1.0), (2017, 1, 3.0), (2017, 2, 1.0), (2018, 3, 3.0)
    ]
    assert build(shop, "order_basket_size") == [(9 / 5, 3)]
    assert build(shop, "order_basket_detail") == [
        ("o1", 3), ("o2", 1), ("o3", 1), ("o4", 3), ("x", 1)
    ]


def test_literal_and_intended_quarterly_revenue_differ(shop):
    # Literal: 1 x 10.10 + 2 x 20.20 + 3 x 500, by month.
    assert build(shop, "quarterly_revenue_summary") == [
        (None, None, 7.0), (2017, 1, pytest.approx(1550.5)), (2018, 3, pytest.approx(26.0))
    ]
    assert build(shop, "quarterly_revenue_by_quarter") == [
        (None, None, 7.0), (2017, 1, pytest.approx(530.3)), (2018, 1, pytest.approx(17.0))
    ]


def test_revenue_by_product(shop):
    summed = build(shop, "monthly_average_revenue_by_product")
    assert (2017, 1, "p1", pytest.approx(30.3)) in summed
    assert (2018, 3, "p1", None) in summed
    assert (2017, 1, "p1", pytest.approx(30.3)) in build(
        shop, "avg_order_revenue_by_product_monthly"
    )
    two = {**shop, "order_items": shop["order_items"].union(
        shop["order_items"].filter("order_id = 'o1'").selectExpr(
            "'o6'", "order_item_id", "product_id", "seller_id", "price * 3", "freight_value")
    ), "orders": shop["orders"].union(
        shop["orders"].filter("order_id = 'o1'").selectExpr(
            "'o6'", "'c6'", *shop["orders"].columns[2:]))}
    assert (2017, 1, "p1", pytest.approx(60.6)) in build(two, "avg_order_revenue_by_product_monthly")
    assert (2017, 1, "p1", pytest.approx(121.2)) in build(two, "monthly_average_revenue_by_product")


def test_yearly_average_keeps_the_null_category(shop):
    assert build(shop, "yearly_average_revenue_by_category") == [
        (None, 2018, 8.5),
        ("toys", None, 7.0),
        ("toys", 2017, pytest.approx(15.15)),
        ("toys", 2018, None),
    ]


def test_period_marts(shop):
    assert build(shop, "period_revenue_total") == [
        (2017, 1, pytest.approx(530.3)), (2017, 2, 5.0), (2018, 3, 17.0)
    ]
    assert build(shop, "period_revenue_total", years=[2017], months=[2]) == [(2017, 2, 5.0)]
    assert build(shop, "period_revenue_by_category") == [
        (2017, 1, "toys", pytest.approx(30.3)), (2017, 2, "toys", 5.0),
        (2018, 3, None, 17.0), (2018, 3, "toys", None),
    ]


def test_category_months_and_pivot(shop):
    assert build(shop, "product_category_order_count_monthly") == [
        ("brinquedos", None, 1), ("brinquedos", 1, 2), ("brinquedos", 2, 1), ("brinquedos", 3, 1)
    ]
    assert build(shop, "category_month_pivot") == [
        ("brinquedos", 2, 1, 1, 0, 0, 0, 0, 0, 0, 0, 0, 0)
    ]


def test_weight_counts_once_per_line(shop):
    assert build(shop, "product_weight_summary_by_city") == [("rio", 400), ("sao paulo", 300)]


def test_payments_are_not_multiplied_by_items(shop):
    assert build(shop, "monthly_revenue_by_payment_type") == [
        (None, None, "boleto", 7.0),
        (2017, 1, "credit_card", 25.0),
        (2017, 1, "voucher", 5.3),
        (2018, 3, "credit_card", 17.0),
    ]
    assert build(shop, "payment_mix_by_state") == [
        ("PE", "boleto", 99.0, 1),
        ("RJ", "boleto", 7.0, 1),
        ("RJ", "credit_card", 17.0, 1),
        ("SP", "credit_card", 25.0, 1),
        ("SP", "voucher", 5.3, 1),
    ]
    assert build(shop, "installments_by_payment_type") == [
        ("boleto", 1.0, 106.0), ("credit_card", 4.0, 42.0), ("voucher", 1.0, 5.3)
    ]
    assert ("boleto", None, None, 1.0) in build(
        shop, "average_installments_by_payment_type_monthly"
    )


def test_delivery(shop):
    assert build(shop, "order_delivery_sla") == [
        ("o1", 5, True), ("o4", -4, False), ("o5", 4, False)
    ]
    assert build(shop, "sp_delivery_delays") == [("o1", 5, True)]
    assert build(shop, "sp_delivery_delays", state="RJ") == []


def test_seller_scorecard(shop):
    # s1: o1 with mean score 4.5, o2 with 1 and canceled, o3 and o4 without a review.
    found = build(shop, "seller_performance_scorecard")
    assert found == [
        ("s1", 2.75, pytest.approx(10.1 + 500 + 5 + 7 + 17), 0.25, "Bronze"),
        ("s2", 4.5, pytest.approx(20.2), 0.0, "Gold"),
    ]
    unreviewed = {**shop, "order_reviews": shop["order_reviews"].limit(0)}
    assert [r[1::3] for r in build(unreviewed, "seller_performance_scorecard")] == [
        (None, "Bronze"), (None, "Bronze")
    ]


def test_review_weeks_start_on_monday(shop):
    assert build(shop, "weekly_review_distribution") == [
        (datetime.date(2017, 1, 16), 4, 1),
        (datetime.date(2017, 1, 16), 5, 1),
        (datetime.date(2017, 1, 30), 1, 1),
    ]


def test_rfm(shop):
    # u1 bought o1 and o4; u2's purchase time is unknown; u3's order has no lines.
    found = {r[0]: r for r in build(shop, "customer_rfm_segments")}
    assert set(found) == {"u1"}
    assert found["u1"][1:4] == (0, 2, pytest.approx(47.3))


def test_rfm_ranks_people(spark, shop):
    n = 50
    people = spark.range(1, n + 1).withColumn("key", F.concat(F.lit("k"), "id"))
    crowd = {
        "orders": people.select(
            F.col("key").alias("order_id"), F.col("key").alias("customer_id"),
            F.lit("delivered").alias("order_status"),
            F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int"))
            .cast("timestamp").alias("order_purchase_timestamp"),
        ),
        "customers": people.select(
            F.col("key").alias("customer_id"), F.col("key").alias("customer_unique_id")
        ),
        "order_items": people.select(F.col("key").alias("order_id")),
        "order_payments": people.select(
            F.col("key").alias("order_id"), F.col("id").cast("double").alias("payment_value")
        ),
    }
    found = {r[0]: r for r in build(crowd, "customer_rfm_segments")}
    assert found["k50"][1:] == (0, 1, 50.0, "Loyal")  # 5 + 1 + 5 points
    assert found["k1"][1:] == (49, 1, 1.0, "Lost")  # 1 + 1 + 1 points
    assert {r[4] for r in found.values()} == {"Loyal", "Potential", "At Risk", "Lost"}
    easy = {r[0]: r[4] for r in build(crowd, "customer_rfm_segments", floors=(11, 9, 7, 5))}
    assert easy["k50"] == "Champion"


def test_repeat_rate_uses_the_state_of_the_latest_order(shop):
    assert build(shop, "customer_repeat_rate") == [
        ("PE", 0.0, 1), ("RJ", 0.5, 2)
    ]


def test_outlier_flags(shop):
    found = build(shop, "product_price_weight_flags", percentile=0.5)
    assert ("p1", 1000.0, 100, True, False) in found
    assert ("p1", None, 100, False, False) in found
    assert ("p3", 9.0, None, False, False) in found
    assert ("p2", 8.0, 200, False, True) in found


def test_star_join_checks_its_path(shop):
    with pytest.raises(ValueError, match="after"):
        star.star_join(shop, ["orders", "order_items", "category_translation"])
    with pytest.raises(ValueError, match="after"):
        star.star_join(shop, ["orders", "sellers"])
    with pytest.raises(ValueError, match="many rows"):
        star.star_join(shop, ["orders", "order_items", "order_payments"])
    with pytest.raises(ValueError, match="no join path"):
        star.star_join(shop, ["orders", "returns"])


def test_geolocation_does_not_multiply_rows(shop):
    located = star.locate(shop["customers"], shop["geolocation"], "customer_zip_code_prefix")
    found = {r.customer_id: (r.lat, r.lng) for r in located.collect()}
    assert len(found) == 5
    assert found["c1"] == (pytest.approx(-23.6), pytest.approx(-46.6))
    assert found["c5"] == (None, None)
