import numpy as np
import pytest

from starmill.operators import quantiles, scans
from starmill.operators.quantiles import exact_quantiles

PROBABILITIES = [0.0, 0.01, 0.25, 0.5, 0.95, 0.999, 1.0]


def check(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")
    found = {r.probability: r.value for r in exact_quantiles(df, ["v"], PROBABILITIES).collect()}
    known = [float(v) for v in values if v is not None and not np.isnan(v)]
    for p in PROBABILITIES:
        assert found[p] == pytest.approx(np.quantile(known, p), rel=1e-12, abs=1e-12), p


@pytest.mark.parametrize("values", [
    [3.0],
    [1.0, 2.0],
    [5.0] * 50,
    [None, 1.5, None, 2.5, float("nan")],
    list(range(-500, 500)),
    [1e-9, 1e9, -1e9, 0.0, 1e300, -1e300],
    [100.01 + i / 100 for i in range(300)] + [1e12],
], ids=["one", "two", "equal", "missing", "signed", "huge", "outlier"])
def test_special_columns(spark, values):
    check(spark, values)


def test_random_columns_with_a_hot_value(spark):
    rng = np.random.default_rng(7)
    values = np.round(rng.lognormal(4, 2, 3000), 2)
    values[:1000] = 99.9
    check(spark, rng.permutation(values))


def test_several_columns_at_once(spark):
    df = spark.range(101).selectExpr("id a", "id * 10.0D b", "cast(null as int) c")
    found = {(r["column"], r.probability): r.value
             for r in exact_quantiles(df, ["a", "b", "c"], [0.5, 0.905]).collect()}
    assert found == {
        ("a", 0.5): 50.0, ("b", 0.5): 500.0,
        ("a", 0.905): pytest.approx(90.5), ("b", 0.905): pytest.approx(905.0),
    }


def test_brackets_hold_few_of_many_values(spark, monkeypatch):
    """400,000 values below 4e-7 and one of 0.0009: only values near the wanted rank are counted."""
    df = spark.range(400_000).selectExpr("(id + 1) * 1e-12 AS v").unionAll(
        spark.sql("SELECT 0.0009D AS v"))
    seen = []
    original = quantiles._counted
    monkeypatch.setattr(
        quantiles, "_counted", lambda *args: seen.append(original(*args)) or original(*args))
    found = exact_quantiles(df, ["v"], [0.5]).first().value
    assert found == pytest.approx(200_001 * 1e-12, rel=1e-9)
    assert len(seen) == 1
    assert 1 < seen[0].filter("value IS NOT NULL").count() < 4000
    assert seen[0].filter("value IS NULL").count() == 2


def test_a_missed_rank_is_found(spark, monkeypatch):
    """Brackets that lie elsewhere cost another pass, not the result."""
    df = spark.range(1000).selectExpr("cast(id AS double) AS v", "cast(id % 7 AS double) AS w")
    passes = []
    original = quantiles._counted
    monkeypatch.setattr(quantiles, "_counted", lambda *args: passes.append(1) or original(*args))
    monkeypatch.setattr(quantiles, "_brackets", lambda values, columns, probabilities: (
        {c: 1000 for c in columns}, {"v": [(3.0, 5.0), (700.0, 701.0)], "w": []}))
    found = {(r["column"], r.probability): r.value
             for r in exact_quantiles(df, ["v", "w"], [0.0, 0.5, 0.9]).collect()}
    assert found == {
        ("v", 0.0): 0.0, ("v", 0.5): 499.5, ("v", 0.9): pytest.approx(899.1),
        ("w", 0.0): 0.0, ("w", 0.5): 3.0, ("w", 0.9): 6.0}
    assert len(passes) == 2


def test_two_reads_and_few_exchanges(spark, tmp_path, monkeypatch):
    """The counting pass has one exchange below the two that number its result."""
    plans = []
    original = scans.stored
    monkeypatch.setattr(scans, "stored", lambda df, label: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or original(df, label))
    spark.range(5000).selectExpr("id", "id % 13 other").write.parquet(str(tmp_path / "t"))
    result = exact_quantiles(spark.read.parquet(str(tmp_path / "t")), ["id", "other"], [0.2, 0.8])
    assert result.count() == 4
    assert len(plans) == 1
    assert plans[0].count("Exchange ") == 3 and plans[0].count("FileScan") == 1
    final = result._jdf.queryExecution().executedPlan().toString()
    assert str(tmp_path / "t") not in final
