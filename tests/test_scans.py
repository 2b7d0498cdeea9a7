"""Running sums over ranges: against plain Python, with hot groups, and without single tasks."""

import random

import pytest
from pyspark.sql import functions as F

from starmill.operators import charts, scans
from starmill.operators.scans import running


def _expected(rows):
    found, sums = {}, {}
    for key, place, value in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        count, total = sums.get(key, (0, 0))
        sums[key] = found[(key, place)] = (count + 1, total + value)
    return found


@pytest.mark.parametrize("hot", [0.0, 0.9, 1.0])
def test_running_sums_equal_python(spark, conf, hot):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    rng = random.Random(3)
    rows = [
        ("hot" if rng.random() < hot else rng.choice(["a", "b", None]), i, rng.randint(0, 9))
        for i in range(2000)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "key string, place long, value long").repartition(6)
    got = running(df, ["key"], ["place"], {"n": F.lit(1), "total": F.col("value")})
    assert got.columns == ["key", "place", "value", "n", "total"]
    assert {(r.key, r.place): (r.n, r.total) for r in got.collect()} == _expected(rows)


def test_a_hot_group_is_in_several_ranges(spark, conf, monkeypatch):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    kept = []
    monkeypatch.setattr(scans, "stored", lambda df, label: kept.append(df) or df)
    df = spark.range(4000).select(F.lit("hot").alias("key"), "id")
    running(df, ["key"], ["id"], {"n": F.lit(1)}).count()
    sizes = [r["count"] for r in kept[0].groupBy(scans.PART).count().collect()]
    assert len(sizes) >= 3 and max(sizes) < 2000


def test_no_rows(spark):
    df = spark.createDataFrame([], "key string, place long")
    assert running(df, ["key"], ["place"], {"n": F.lit(1)}).count() == 0


def test_long_axis_has_no_single_partition(spark):
    df = spark.range(20_000).select(
        F.lit(2017).alias("year"), (F.col("id") % 12 + 1).alias("month"),
        F.format_string("s%06d", F.col("id") * 7919 % 20_000).alias("series"), F.lit(1.0).alias("x"),
    )
    surface = charts.surface(df, "year", "month", "series", "x")
    plan = surface._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan
    rows = surface.collect()
    assert [r.series for r in sorted(rows, key=lambda r: r.series_idx)] == sorted(r.series for r in rows)
    assert sorted(r.series_idx for r in rows) == list(range(20_000))
    assert {r.period_idx for r in rows} == set(range(12))
