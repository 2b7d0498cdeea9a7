"""Each check must pass on good rows and be seen to fail on planted bad ones."""

import pytest
from pyspark.sql import functions as F

import starmill
from starmill.operators import checks


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0].passed, found[0].observed


@pytest.fixture
def gold(spark):
    return spark.createDataFrame(
        [(2017, 1, "toys", 10.0, "voucher"), (2017, 2, "toys", 20.0, "boleto")],
        "order_year int, order_month int, category string, total_revenue double, payment_type string",
    )


@pytest.fixture
def bad(spark, gold):
    planted = spark.createDataFrame(
        [(2017, 13, None, 0.0, "cash"), (2017, 1, "toys", None, None)], gold.schema
    )
    return gold.union(planted)


@pytest.mark.parametrize("make, args, broken", [
    (checks.satisfies, ["total_revenue > 0"], 2),
    (checks.not_null, ["category"], 1),
    (checks.between, ["order_month", 1, 12], 1),
    (checks.between, ["total_revenue", 1, float("inf")], 2),
    (checks.in_set, ["payment_type", ["voucher", "boleto"]], 2),
])
def test_row_rules(gold, bad, make, args, broken):
    rule = make(*args)
    assert one(checks.check_rows(gold, [rule])) == (True, 0)
    assert one(checks.check_rows(bad, [rule])) == (False, broken)


def test_rules_share_one_pass(gold):
    rules = [checks.not_null("category"), *checks.period_scope("order_year", "order_month", [2017], [1])]
    found = checks.check_rows(gold, rules)
    assert [(r.passed, r.observed) for r in found.collect()] == [(True, 0), (True, 0), (False, 1)]
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1


def test_empty_table_has_no_violations_but_is_not_non_empty(gold):
    empty = gold.limit(0)
    assert one(checks.check_rows(empty, [checks.not_null("category")])) == (True, 0)
    assert one(checks.check_non_empty(empty)) == (False, 0)
    assert one(checks.check_non_empty(gold)) == (True, 2)
    assert one(checks.check_non_empty(gold, "category", 2)) == (False, 1)


def test_rowcount_equals_distinct(gold, bad):
    assert one(checks.check_rowcount_equals_distinct(gold, bad, "order_month")) == (False, 2)
    assert one(checks.check_rowcount_equals_distinct(gold, gold, "order_month")) == (True, 2)


def test_unique_grain(gold, bad):
    assert one(checks.check_unique_grain(gold, ["order_year", "order_month"])) == (True, 0)
    assert one(checks.check_unique_grain(bad, ["order_year", "order_month"])) == (False, 1)


def test_reconcile(spark, gold, bad):
    keys, measures = ["order_year", "order_month", "category"], ["total_revenue"]
    assert one(checks.check_reconcile(bad.filter("total_revenue IS NOT NULL"),
                                      bad.filter("total_revenue IS NOT NULL"), keys, measures))[0]
    assert one(checks.check_reconcile(gold, gold.limit(1), keys, measures)) == (False, 1)
    assert one(checks.check_reconcile(gold.limit(1), gold, keys, measures)) == (False, 1)
    off = gold.withColumn("total_revenue", gold.total_revenue + 0.01)
    assert one(checks.check_reconcile(gold, off, keys, measures)) == (False, 2)
    assert one(checks.check_reconcile(gold, off, keys, measures, tolerance=0.02)) == (True, 0)


def test_reconcile_matches_null_keys_without_comparing_all_pairs(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    table = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "k string, v double")
    result = checks.check_reconcile(table, table, ["k"], ["v"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan
    assert one(result) == (True, 0)


def test_only_differing_buckets_are_joined(spark):
    left = spark.range(5000).selectExpr("id AS k", "IF(id % 7 = 0, NULL, id * 2) AS a", "id / 3 AS b")
    right = left.selectExpr("cast(k AS int) AS k", "cast(a AS double) AS a", "b")
    parts = checks.differing_buckets(left, right.orderBy(F.desc("k")), ["k"], ["a", "b"])
    assert [p.count() for p in parts] == [0, 0]
    off = right.filter("k <> 12").withColumn("b", F.when(F.col("k") != 99, F.col("b")).otherwise(1.0))
    mine, theirs = checks.differing_buckets(left, off, ["k"], ["a", "b"])
    assert {12, 99} <= {r.k for r in mine.collect()} and 2 <= mine.count() < 30
    assert {r.k for r in theirs.collect()} == {r.k for r in mine.collect()} - {12}
    assert one(checks.check_reconcile(left, off, ["k"], ["a", "b"])) == (False, 2)
    swapped = spark.createDataFrame([(1, None, 2.0)], "k long, a double, b double")
    other = spark.createDataFrame([(1, 2.0, None)], "k long, a double, b double")
    assert one(checks.check_reconcile(swapped, other, ["k"], ["a", "b"])) == (False, 1)


def test_spot_value(gold):
    at = {"order_year": 2017, "order_month": 2}
    doubled = gold.withColumn("total_revenue", gold.total_revenue * 2)
    assert one(checks.check_spot_value(gold, gold, at, "total_revenue")) == (True, 20)
    assert one(checks.check_spot_value(gold, doubled, at, "total_revenue")) == (False, 20)
    missing = {"order_year": 2017, "order_month": 7}
    assert one(checks.check_spot_value(gold, gold, missing, "total_revenue")) == (False, None)


def test_allowlist(spark, gold, shop):
    allowed = shop["category_translation"]
    column = "product_category_name_english"
    assert one(checks.check_allowlist(gold, "category", allowed, column)) == (True, 0)
    yachts = gold.union(spark.createDataFrame(
        [(2017, 1, "luxury_yachts", 1.0, "voucher")], gold.schema))
    assert one(checks.check_allowlist(yachts, "category", allowed, column)) == (False, 1)


def test_acceptance_sql(spark, gold):
    table = "gold.monthly_revenue_summary"
    criteria = [
        f"SELECT COUNT(*) FROM {table} WHERE year IN (2016, 2017) AND month IN (1, 2, 3)",
        f"SELECT SUM(revenue) FROM {table} WHERE year = 2017 AND month = 2",
        f"SELECT SUM(total_revenue) FROM {table} WHERE order_year = 2023",
        f"SELECT COUNT(*) FROM {table} WHERE total_revenue < 0",
        f"SELECT order_month, total_revenue FROM {table} WHERE order_month IS NOT NULL LIMIT 10",
        f"SELECT order_month, total_revenue FROM {table} WHERE order_month > 12",
        f"SELECT AVG(profit_margin) FROM {table}",
        "SELECT COUNT(*) FROM gold.no_such_table",
    ]
    found = checks.check_acceptance_sql(spark, {"monthly_revenue_summary": gold}, criteria)
    results = {r.check: (r.passed, r.observed) for r in found.collect()}
    assert [results[c] for c in criteria] == [
        (True, 2), (True, 20), (False, None), (False, 0), (True, 2), (False, 0),
        (False, None), (False, None),
    ]


def test_report_fails_only_on_errors(gold):
    good = checks.check_non_empty(gold)
    broken = checks.check_rows(gold, [checks.satisfies("total_revenue > 15")])
    warned = checks.validation_report({"error": [good], "warning": [broken]}).collect()
    assert {(r.overall_passed, r.score) for r in warned} == {(True, 0.5)}
    failed = checks.validation_report({"error": [good, broken]}).collect()
    assert {r.overall_passed for r in failed} == {False}
    assert {r.message for r in failed if not r.passed} == {
        "observed 1.00, expected no violating rows"
    }


def test_audit_is_appended(spark, gold, tmp_path):
    report = checks.validation_report({"error": [checks.check_non_empty(gold)]})
    path = str(tmp_path / "audit")
    checks.append_audit(report, path, "a")
    checks.append_audit(report, path, "b")
    assert sorted(r.run_id for r in checks.read_audit(spark, path).collect()) == ["a", "b"]


def test_a_repeated_run_leaves_one_set_of_rows(spark, gold, tmp_path):
    path = str(tmp_path / "audit")
    report = checks.validation_report({"error": [checks.check_non_empty(gold)]})
    for run in ("1", "2", "1", "a/b='c'", "a/b='c'"):
        checks.append_audit(report, path, run)
    found = checks.read_audit(spark, path)
    assert sorted(r.run_id for r in found.collect()) == ["1", "2", "a/b='c'"]
    assert found.columns == [*report.columns, "run_id"]
    assert dict(found.dtypes)["run_id"] == "string"


def test_every_mart_has_checkable_rules(shop):
    for name in starmill.mart_names():
        rules = checks.mart_rules(starmill.spec(name))
        if rules:
            assert checks.check_rows(starmill.build(name, shop), rules).count() == len(rules)


def test_acceptance_listings_and_views(spark):
    table = spark.createDataFrame([("a", 1), ("b", 0)], "state string, n int")
    before = {t.name for t in spark.catalog.listTables()}
    found = checks.check_acceptance_sql(spark, {"t": table}, [
        "SELECT DISTINCT state FROM gold.t",
        "SELECT n FROM gold.t",
        "SELECT max(state) FROM gold.t WHERE n > 5",
        "SELECT sum(n) FROM gold.t WHERE n = 0",
        "SELECT state, n FROM gold.t WHERE n > 5",
    ]).collect()
    assert [(r.passed, r.observed) for r in found] == [
        (True, 2.0), (True, 2.0), (False, 1.0), (False, 0.0), (False, 0.0)]
    assert {t.name for t in spark.catalog.listTables()} == before
