"""Exact sums against math.fsum, in any order, in one step or several."""

import math
import random

import pytest
from pyspark.sql import functions as F

from starmill.operators.sums import add_up, once, totals, with_limbs


def total(df):
    return totals(with_limbs(df, v="v"), [], ["v"], {"n": F.count("v_bin")}).first()


CASES = {
    "small": [0.00004] * 1000,
    "smaller": [1e-25] * 1000,
    "thirds": [13 / 3, 10 / 3, 13 / 3],
    "large": [1e19, 1e19],
    "signed": [-1e-9, 1e-12, 3.0, -7.25],
    "infinite": [float("inf"), 2.0, float("-inf"), float("nan"), None],
    "cancelling": [2.0**61, 1.0, -(2.0**61)],
    "cancelling bins": [1e300, 5.0, 1e-300, -1e300, -5.0],
    "just below zero": [2.0**72, -(2.0**72) - 2.0**20, -1e-9, 2.0**20],
    "every size": [1e300, 5.0, 1e-300],
    "subnormal": [5e-324] * 3 + [2.0**-1022, -5e-324],
    "largest": [1.7976931348623157e308, -1e308, 9e307],
    "zeros": [0.0, -0.0],
    "powers": [2.0**e for e in range(-1074, 1020, 7)] + [-(2.0**e) for e in range(-1070, 1020, 11)],
    "half way": [1.0, 2.0**-53, 2.0**-200],
    "half way down": [1.0, 2.0**-53, -(2.0**-200)],
}


@pytest.mark.parametrize("name", CASES)
def test_sums_are_those_of_fsum(spark, name):
    known = [v for v in CASES[name] if v is not None and math.isfinite(v)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(CASES[name])], "i int, v double")
    assert tuple(total(df)) == (math.fsum(known), len(known))


def test_random_sums_in_any_order_and_by_parts(spark):
    rng = random.Random(8)
    groups = {}
    for _ in range(6000):
        scale = rng.choice([2.0, 2.0, 10.0, 300.0])
        value = rng.choice([-1, 1]) * rng.random() * 10 ** rng.uniform(-scale, scale)
        groups.setdefault(rng.randint(0, 60), []).append(value)
    rows = [(k, i % 5, v) for k, values in groups.items() for i, v in enumerate(values)]
    rows += [(k, 7, -v) for k, values in groups.items() if k % 3 == 0 for v in values[1:]]
    want = {}
    for k, _, v in rows:
        want.setdefault(k, []).append(v)
    want = {k: math.fsum(v) for k, v in want.items()}
    for seed in (1, 2):
        rng.shuffle(rows)
        df = with_limbs(spark.createDataFrame(rows, "k int, part int, v double").repartition(3), v="v")
        assert dict(tuple(r) for r in totals(df, ["k"], ["v"]).collect()) == want
        parts = add_up(df, ["k", "part"], ["v"])
        assert dict(tuple(r) for r in totals(parts, ["k"], ["v"]).collect()) == want


def test_no_value_is_no_sum(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan"))], "k int, v double")
    assert total(df)["v"] is None
    assert [r.v for r in totals(with_limbs(df, v="v"), ["k"], ["v"]).collect()] == [None, None]
    assert total(df.limit(0))["n"] is None or total(df.limit(0))["v"] is None


def test_many_large_values_do_not_overflow(spark):
    df = spark.range(70_000_000).select(F.lit(4e18).alias("v"))
    assert total(df)["v"] == 7e7 * 4e18


def test_one_row_of_a_group_counts(spark):
    rows = [(1, 1.0), (1, 1e30), (1, 1e-30), (2, None), (3, 5.0)]
    df = with_limbs(spark.createDataFrame(rows, "k int, v double"), v="v")
    marked = once(add_up(df, ["k"], ["v"]), ["k"], "v", "n")
    assert marked.count() > 3
    assert {r.k: r.n for r in marked.groupBy("k").agg(F.sum("n").alias("n")).collect()} == {1: 1, 2: 1, 3: 1}
    assert marked.filter("n = 1 AND k <> 2 AND v_bin IS NULL").isEmpty()
