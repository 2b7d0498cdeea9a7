import numpy as np
import pytest

from conftest import rows
from starmill.functions import quarter_label
from starmill.operators import charts, profiling


@pytest.fixture
def sample(spark):
    return spark.createDataFrame(
        [("a", 1, 2.0), ("b", 2, None), ("a", 3, 6.0), (None, 4, 0.0), ("a", 3, 6.0)],
        "label string, k int, v double",
    )


def test_profile(sample):
    found = {r["column"]: r.asDict() for r in profiling.profile_columns(sample).collect()}
    label, k, v = found["label"], found["k"], found["v"]
    assert (label["type"], label["count"], label["missing"], label["distinct"]) == ("string", 4, 1, 2)
    assert (label["min"], label["max"], label["mean"], label["p50"]) == ("a", "b", None, None)
    assert (k["count"], k["distinct"], k["mean"], k["p25"], k["p75"]) == (5, 4, 2.6, 2.0, 3.0)
    assert (v["missing"], v["zeros"], v["p50"]) == (1, 1, 4.0)
    assert v["std"] == pytest.approx(np.std([2.0, 6.0, 0.0, 6.0], ddof=1))


def test_profile_with_sketched_distinct_counts(sample):
    found = {r["column"]: r["distinct"]
             for r in profiling.profile_columns(sample, distinct_error=0.02).collect()}
    assert found == {"label": 2, "k": 4, "v": 3}


def test_profile_of_empty_and_text_only_tables(sample):
    assert {r["count"] for r in profiling.profile_columns(sample.limit(0)).collect()} == {0}
    text = profiling.profile_columns(sample.select("label")).first()
    assert text["distinct"] == 2 and text["p50"] is None


def test_top_values(sample):
    assert rows(profiling.profile_top_values(sample, ["label", "k"], 2)) == [
        ("k", 1, "3", 2), ("k", 2, "1", 1), ("label", 1, "a", 3), ("label", 2, "b", 1)
    ]


def test_histogram(sample, spark):
    assert rows(profiling.profile_histogram(sample, ["v"], 3)) == [
        ("v", 0, 0.0, 2.0, 1), ("v", 1, 2.0, 4.0, 1), ("v", 2, 4.0, 6.0, 2)
    ]
    same = spark.createDataFrame([(7.0,), (7.0,)], "v double")
    assert rows(profiling.profile_histogram(same, ["v"], 4)) == [
        ("v", 0, 7.0, 7.0, 2), ("v", 1, 7.0, 7.0, 0), ("v", 2, 7.0, 7.0, 0), ("v", 3, 7.0, 7.0, 0)
    ]


def test_correlation(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=200), rng.normal(size=200)
    df = spark.createDataFrame([(float(x), float(y), float(x + y)) for x, y in zip(a, b)],
                               "a double, b double, c double")
    found = {(r.column_a, r.column_b): r.correlation
             for r in profiling.profile_correlation(df).collect()}
    want = np.corrcoef([a, b, a + b])
    assert found == {("a", "b"): pytest.approx(want[0, 1]), ("a", "c"): pytest.approx(want[0, 2]),
                     ("b", "c"): pytest.approx(want[1, 2])}


def test_smoke(sample):
    assert rows(profiling.profile_smoke(sample)) == [(5, 2 / 15, 1)]
    assert rows(profiling.profile_smoke(sample.limit(0))) == [(0, 0.0, 0)]


@pytest.fixture
def monthly(spark):
    return spark.createDataFrame(
        [(2017, 2, "toys", 5.0), (2016, 12, "toys", 1.0), (2017, 2, "books", 2.0),
         (None, 1, "books", 4.0), (2017, 10, None, None)],
        "order_year int, order_month int, category string, revenue double",
    )


def test_line_is_in_time_order(monthly):
    found = charts.line(monthly, "order_year", "order_month", "revenue")
    assert [tuple(r) for r in found.collect()] == [
        ("2016-12", 1.0), ("2017-02", 7.0), ("2017-10", 0.0), ("unknown", 4.0)
    ]
    scoped = charts.line(monthly, "order_year", "order_month", "revenue", [2017], [1, 2, 3])
    assert [tuple(r) for r in scoped.collect()] == [("2017-02", 7.0)]


def test_quarters(spark):
    df = spark.createDataFrame([(2017, 4, 1.0), (2017, 1, 2.0), (2016, 3, 3.0)], "y int, q int, v double")
    found = charts.line(df, "y", "q", "v", label=quarter_label)
    assert [tuple(r) for r in found.collect()] == [
        ("2016-Q3", 3.0), ("2017-Q1", 2.0), ("2017-Q4", 1.0)
    ]


def test_rank_sorts_before_it_cuts(spark):
    # The largest categories come last: cutting first would lose them.
    df = spark.range(100).selectExpr("concat('c', id) AS c", "id AS v")
    assert [r.c for r in charts.rank(df, "c", "v", 3).collect()] == ["c99", "c98", "c97"]


def test_surface(monthly):
    found = charts.surface(monthly, "order_year", "order_month", "category", "revenue")
    assert [tuple(r) for r in found.orderBy("period", "series").collect()] == [
        ("2016-12", "toys", 1.0, 0, 1), ("2017-02", "books", 2.0, 1, 0),
        ("2017-02", "toys", 5.0, 1, 1), ("2017-10", "unknown", 0.0, 2, 2),
        ("unknown", "books", 4.0, 3, 0),
    ]


def test_surface_has_all_points(spark):
    df = spark.range(500).selectExpr(
        "2000 + id AS y", "1 AS m", "concat('s', id % 3) AS s", "id AS v")
    found = charts.surface(df, "y", "m", "s", "v").collect()
    assert len(found) == 500 and sorted(r.period_idx for r in found) == list(range(500))
    assert {r.series_idx for r in found} == {0, 1, 2}


def test_grouped_bar_and_scatter(monthly):
    assert ("unknown", "2017", 0.0) in rows(
        charts.grouped_bar(monthly, "category", "order_year", "revenue"))
    assert len(charts.scatter(monthly, ["category"], "order_month", "revenue").collect()) == 4


def test_composition(spark, monthly):
    found = [tuple(r) for r in charts.composition(monthly, "category", "revenue").collect()]
    assert found == [("books", 6.0, 0.5, 3), ("toys", 6.0, 0.5, 3), ("unknown", 0.0, 0.0, 3)]
    many = spark.range(9).selectExpr("concat('c', id) AS c", "id + 1 AS v")
    bars = charts.composition(many, "c", "v").collect()
    assert len(bars) == 9 and {r.categories for r in bars} == {9} and bars[0].share == 9 / 45
    assert sum(r.share for r in bars) == pytest.approx(1.0)


def test_column_roles(spark):
    df = spark.createDataFrame(
        [(2017, "a long category name", "1.5", ""), (2018, "another long category", " -2e3 ", "x")],
        "order_year int, category string, text_number string, note string",
    )
    found = {r["column"]: (r.role, r.n_values, r.horizontal) for r in charts.column_roles(df).collect()}
    assert found == {
        "order_year": ("time", 2, False), "category": ("category", 2, True),
        "text_number": ("metric", 2, False), "note": ("category", 1, False),
    }


def test_histogram_has_empty_bins_and_no_nan(spark):
    df = spark.createDataFrame(
        [(0.0,), (10.0,), (float("nan"),), (float("inf"),), (None,)], "v double")
    found = rows(profiling.profile_histogram(df, ["v"], 5))
    assert [(r[1], r[4]) for r in found] == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 1)]
    profile = profiling.profile_columns(df).first()
    assert (profile["count"], profile.missing, profile.mean, profile["max"]) == (2, 3, 5.0, "10.0")


def test_roles_list_columns_without_values(spark):
    df = spark.createDataFrame([(None, "", 1)], "nothing string, blank string, n int")
    found = {r["column"]: (r.position, r.role, r.n_values) for r in charts.column_roles(df).collect()}
    assert found == {"nothing": (0, "category", 0), "blank": (1, "category", 0), "n": (2, "metric", 1)}
