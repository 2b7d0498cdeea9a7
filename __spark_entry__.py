
from __future__ import annotations

import sys
from collections.abc import Callable
from functools import partial
from importlib.util import find_spec
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import starmill  # noqa: E402
from starmill.functions import in_period  # noqa: E402
from starmill.operators import charts, checks, logs, profiling, star  # noqa: E402
from starmill.plans.common import CATEGORY, in_months  # noqa: E402
from starmill.session import stored  # noqa: E402
from starmill.sources import gold, warehouse  # noqa: E402
from starmill.sources.bronze import CSV_OPTIONS, LakeConfig, conform, read_bronze  # noqa: E402

from oracle_queries import ORACLE, ORACLE_DIGITS, ORACLE_NUDGE  # noqa: E402

# The training-data operators are optional: their files may be absent. If they are there, they must work.
corpus_pipeline = llm_queries = None
if find_spec("starmill.llm") and find_spec("corpus_pipeline"):
    import corpus_pipeline  # noqa: E402
    from starmill.llm import queries as llm_queries  # noqa: E402

# The given tables hold the years 1995 to 2001.
YEARS, MONTHS = [1996, 1997, 1998], [1, 2, 3]

# Arguments that suit the given tables, where a mart's defaults do not.
MART_ARGS: dict[str, dict] = {
    "period_revenue_by_product": {"years": YEARS},
    "period_revenue_total": {"years": YEARS},
    "period_revenue_by_category": {"years": YEARS},
    "sp_delivery_delays": {"state": "ASIA"},
    "seller_performance_scorecard": {
        "gold_score": 3.0, "gold_cancel": 0.33, "silver_score": 2.9,
    },
    "freight_by_category_filtered": {
        "start": "1996-01-01", "end": "1998-01-01", "states": ["ASIA", "EUROPE"],
    },
}


def _mart(spark: SparkSession, folder: str, name: str, **args) -> DataFrame:
    starmill.configure(spark)
    tables = warehouse.bronze_tables(spark, folder, list(starmill.spec(name).sources))
    return starmill.build(name, tables, **{**MART_ARGS.get(name, {}), **args})


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    starmill.configure(spark)
    return warehouse.bronze_tables(spark, folder, [name])[name]


def _lake(spark: SparkSession, label: str) -> LakeConfig:
    return LakeConfig(starmill.scratch_dir(spark, label))


# --- scans, sinks, catalog ---------------------------------------------------------------


def scan_bronze_parquet(spark: SparkSession, folder: str) -> DataFrame:
    lake = _lake(spark, "scan-parquet")
    path = lake.bronze_path("order_items", "parquet")
    conform(_table(spark, folder, "order_items"), "order_items").write.parquet(path)
    return read_bronze(spark, lake, "olist_order_items_raw", "parquet").withColumn(
        "shipping_limit_date", F.to_date("shipping_limit_date")
    )


def scan_bronze_csv(spark: SparkSession, folder: str) -> DataFrame:
    lake = _lake(spark, "scan-csv")
    orders = conform(_table(spark, folder, "orders"), "orders")
    orders.write.options(**CSV_OPTIONS).csv(lake.bronze_path("orders", "csv"))
    return read_bronze(spark, lake, "olist_orders_raw", "csv").select(
        "order_id",
        "customer_id",
        "order_status",
        F.to_date("order_purchase_timestamp").alias("purchase_date"),
        F.to_date("order_delivered_customer_date").alias("delivered_date"),
        F.to_date("order_estimated_delivery_date").alias("estimated_date"),
    )


def scan_bronze_csv_multiline(spark: SparkSession, folder: str) -> DataFrame:
    """Reviews whose comments hold line breaks, quotes and commas, written as CSV and read back."""
    lake = _lake(spark, "scan-csv-lines")
    title = F.concat(F.lit('said "'), F.col("review_id"), F.lit('",\nand '), F.col("review_score"))
    message = F.when(F.col("review_id") % 3 > 0, F.concat(F.lit("one\n\n"), title))
    reviews = conform(_table(spark, folder, "order_reviews"), "order_reviews").withColumns(
        {"review_comment_title": title, "review_comment_message": message}
    )
    reviews.write.options(**CSV_OPTIONS).csv(lake.bronze_path("order_reviews", "csv"))
    return read_bronze(spark, lake, "olist_order_reviews_raw", "csv").select(
        "review_id", "review_score", "review_comment_title", "review_comment_message",
        F.to_date("review_creation_date").alias("created"),
    )


def _write_mart(spark: SparkSession, folder: str, name: str, **options) -> tuple[LakeConfig, str]:
    lake = _lake(spark, name)
    mart = starmill.spec(name)
    df = _mart(spark, folder, name)
    return lake, gold.write_gold(df, lake, mart.target_table, mart.columns, **options)


def _written(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The mart as a stored table, for checks that read it more than once."""
    _, path = _write_mart(spark, folder, name)
    return spark.read.parquet(path)


def sink_gold_parquet(spark: SparkSession, folder: str) -> DataFrame:
    return _written(spark, folder, "monthly_revenue_summary")


def sink_gold_partition_overwrite(spark: SparkSession, folder: str) -> DataFrame:
    """Write all years, then rewrite 1997 with doubled revenue; other years stay as written."""
    name = "monthly_revenue_summary"
    lake, path = _write_mart(spark, folder, name, partition_by=["order_year"])
    again = _mart(spark, folder, name).filter("order_year = 1997").withColumn(
        "total_revenue", F.col("total_revenue") * 2
    )
    gold.write_gold(
        again, lake, f"gold.{name}", partition_by=["order_year"], replace_partitions=True
    )
    return spark.read.parquet(path)


def sink_gold_publish(spark: SparkSession, folder: str) -> DataFrame:
    """Publish a mart, then publish it again with doubled revenue; the catalog shows the second."""
    name = "monthly_revenue_summary"
    mart, lake = starmill.spec(name), _lake(spark, f"{name}-versions")
    df = _mart(spark, folder, name)
    for factor in (1, 2):
        scaled = df.withColumn("total_revenue", F.col("total_revenue") * factor)
        gold.publish_gold(scaled, lake, "gold.published_revenue", mart.columns)
    return spark.table("gold.published_revenue")


def catalog_register_gold(spark: SparkSession, folder: str) -> DataFrame:
    mart = starmill.spec("order_count_by_quarter")
    _, path = _write_mart(spark, folder, mart.name)
    return gold.register_gold(spark, mart.target_table, path, mart.columns)


def gold_preview(spark: SparkSession, folder: str) -> DataFrame:
    mart = starmill.spec("order_count_by_seller_state_city")
    return gold.preview(_mart(spark, folder, mart.name), mart.grain, 20)


# --- filters and joins -------------------------------------------------------------------


def filter_period_in(spark: SparkSession, folder: str) -> DataFrame:
    return _mart(spark, folder, "monthly_revenue_summary", years=YEARS, months=MONTHS).filter(
        in_period("order_year", "order_month", YEARS, MONTHS)
    )


def join_translation_left(spark: SparkSession, folder: str) -> DataFrame:
    products = _table(spark, folder, "products")
    return star.translated(products, _table(spark, folder, "category_translation")).select(
        "product_id", "product_category_name", CATEGORY, "product_weight_g"
    )


def join_geolocation_zip(spark: SparkSession, folder: str) -> DataFrame:
    customers = _table(spark, folder, "customers")
    located = star.locate(
        customers, _table(spark, folder, "geolocation"), "customer_zip_code_prefix"
    )
    return located.select("customer_id", "customer_zip_code_prefix", "lat", "lng")


def star_join(spark: SparkSession, folder: str) -> DataFrame:
    wanted = ["orders", "order_items", "products", "category_translation", "sellers", "customers"]
    starmill.configure(spark)
    return star.star_join(warehouse.bronze_tables(spark, folder, wanted), wanted).select(
        "order_id", "order_item_id", "product_id", "seller_id", CATEGORY,
        "customer_state", "seller_state", "price",
    )


# --- checks ------------------------------------------------------------------------------


def check_acceptance_sql(spark: SparkSession, folder: str) -> DataFrame:
    names = ["monthly_revenue_summary", "order_count_by_seller_state"]
    months, states = (f"gold.{n}" for n in names)
    criteria = [
        f"SELECT count(*) AS n FROM {months} WHERE year BETWEEN 1996 AND 1998 AND month < 4",
        f"SELECT sum(revenue) AS spring FROM {months} WHERE year = 1996 AND month = 4",
        f"SELECT avg(total_revenue) AS mean FROM {months} WHERE order_year = 1997",
        f"SELECT sum(revenue) AS future FROM {months} WHERE year > 2100",
        f"SELECT sum(margin) AS margin FROM {months}",
        f"SELECT DISTINCT seller_state FROM {states}",
        f"SELECT total_orders FROM {states} WHERE total_orders > 0",
        f"SELECT seller_state, total_orders FROM {states} WHERE total_orders < 0",
    ]
    marts = {n: _written(spark, folder, n) for n in names}
    return checks.check_acceptance_sql(spark, marts, criteria)


def check_row_predicates(spark: SparkSession, folder: str) -> DataFrame:
    revenue = _mart(spark, folder, "monthly_revenue_summary")
    sla = _mart(spark, folder, "order_delivery_sla")
    return checks.union([
        checks.check_rows(revenue, [checks.satisfies("total_revenue > 0")]),
        checks.check_rows(
            sla, [checks.satisfies("delivery_days >= 0"), checks.satisfies("NOT is_late")]
        ),
    ])


def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    return checks.union([
        checks.check_rows(_mart(spark, folder, name), [checks.not_null(CATEGORY)])
        for name in ("monthly_revenue_summary", "yearly_average_revenue_by_category")
    ])


def check_between(spark: SparkSession, folder: str) -> DataFrame:
    ranges = {
        "monthly_revenue_summary": checks.between("order_month", 1, 12),
        "customer_repeat_rate": checks.between("repeat_rate", 0, 1),
        "order_delivery_sla": checks.between("delivery_days", 0, 30),
    }
    return checks.union([
        checks.check_rows(_mart(spark, folder, name), [rule]) for name, rule in ranges.items()
    ])


def check_in_set(spark: SparkSession, folder: str) -> DataFrame:
    mix = _mart(spark, folder, "payment_mix_by_state")
    rules = checks.mart_rules(starmill.spec("payment_mix_by_state"))
    return checks.check_rows(mix, rules + [checks.in_set("customer_state", ["ASIA", "EUROPE"])])


def check_rowcount_equals_distinct(spark: SparkSession, folder: str) -> DataFrame:
    return checks.check_rowcount_equals_distinct(
        _mart(spark, folder, "installments_by_payment_type"),
        _table(spark, folder, "order_payments"),
        "payment_type",
    )


def check_unique_grain(spark: SparkSession, folder: str) -> DataFrame:
    monthly = _mart(spark, folder, "average_items_per_order_monthly")
    lines = _table(spark, folder, "order_items")
    return checks.union([
        checks.check_unique_grain(monthly, ["order_year", "order_month"]),
        checks.check_unique_grain(lines, ["order_id", "order_item_id"]),
    ])


def check_reconcile_bronze(spark: SparkSession, folder: str) -> DataFrame:
    """The written weight mart against a recomputation straight from the line items."""
    table = _written(spark, folder, "product_weight_summary_by_city")
    wanted = ["orders", "order_items", "customers"]
    lines = star.star_join(warehouse.bronze_tables(spark, folder, wanted), wanted)
    shipped = lines.groupBy("customer_city", "product_id").agg(F.count("*").alias("n"))
    weight = F.sum(F.col("product_weight_g") * F.col("n")).alias("total_weight")
    products = _table(spark, folder, "products")
    recomputed = shipped.join(products, "product_id").groupBy("customer_city").agg(weight)
    return checks.check_reconcile(table, recomputed, ["customer_city"], ["total_weight"])


def check_period_scope(spark: SparkSession, folder: str) -> DataFrame:
    scoped = checks.check_rows(
        _mart(spark, folder, "period_revenue_by_category"),
        checks.period_scope("year", "month", YEARS, MONTHS),
    )
    whole = checks.check_rows(
        _mart(spark, folder, "monthly_revenue_summary"),
        checks.period_scope("order_year", "order_month", YEARS, MONTHS),
    )
    return checks.union([scoped, whole])


def check_spot_value(spark: SparkSession, folder: str) -> DataFrame:
    monthly = _written(spark, folder, "average_installments_by_payment_type_monthly")
    spots = [
        {"payment_type": "credit_card", "year": 1997, "month": 1},
        {"payment_type": "boleto", "year": 1998, "month": 12},
    ]
    orders = in_months(_table(spark, folder, "orders"), [1997, 1998], [1, 12])
    raw = (
        _table(spark, folder, "order_payments").join(orders, "order_id")
        .withColumn("year", F.year("order_purchase_timestamp"))
        .withColumn("month", F.month("order_purchase_timestamp"))
        .groupBy("payment_type", "year", "month")
        .agg(
            (F.sum("payment_installments") / F.count("payment_installments"))
            .alias("average_installments")
        )
    )
    return checks.check_spot_values(monthly, raw, spots, "average_installments")


def check_non_empty(spark: SparkSession, folder: str) -> DataFrame:
    freight = _written(spark, folder, "freight_by_category")
    return checks.union([
        checks.check_non_empty(freight),
        checks.check_non_empty(freight, CATEGORY),
        checks.check_non_empty(freight.filter("avg_price < 0")),
    ])


def check_category_allowlist(spark: SparkSession, folder: str) -> DataFrame:
    translation = _table(spark, folder, "category_translation")
    return checks.union([
        checks.check_allowlist(
            _mart(spark, folder, "monthly_revenue_summary"), CATEGORY, translation, CATEGORY
        ),
        checks.check_allowlist(
            _table(spark, folder, "products"),
            "product_category_name", translation, "product_category_name",
        ),
    ])


def validation_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report on the monthly revenue mart, appended to an audit table and read back."""
    spec = starmill.spec("monthly_revenue_summary")
    lake, path = _write_mart(spark, folder, spec.name)
    table = spark.read.parquet(path)
    report = checks.validation_report({
        "error": checks.mart_checks(table, spec),
        "warning": [checks.check_rows(table, [checks.satisfies("total_orders >= 20")])],
    })
    audit = checks.append_audit(report, lake.gold_path("validation_audit"), "first run")
    return spark.read.parquet(audit)


# --- profiles ----------------------------------------------------------------------------


def profile_columns(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.profile_columns(join_translation_left(spark, folder))


def profile_top_values(spark: SparkSession, folder: str) -> DataFrame:
    sla = _mart(spark, folder, "order_delivery_sla")
    return profiling.profile_top_values(sla, ["delivery_days", "is_late"], 5)


def profile_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.profile_histogram(
        _table(spark, folder, "order_items"), ["price", "order_item_id"], 10
    )


def profile_correlation(spark: SparkSession, folder: str) -> DataFrame:
    return profiling.profile_correlation(
        _table(spark, folder, "order_items"), ["price", "freight_value", "order_item_id"]
    )


def profile_smoke(spark: SparkSession, folder: str) -> DataFrame:
    lines = star.translated(
        _table(spark, folder, "order_items").join(_table(spark, folder, "products"), "product_id"),
        _table(spark, folder, "category_translation"),
    )
    return profiling.profile_smoke(
        lines.select("order_id", "order_item_id", "product_category_name", CATEGORY)
    )


# --- charts ------------------------------------------------------------------------------


def chart_preview_line(spark: SparkSession, folder: str) -> DataFrame:
    gold_table = _mart(spark, folder, "monthly_revenue_summary", years=YEARS, months=MONTHS)
    return charts.line(gold_table, "order_year", "order_month", "total_revenue", YEARS, MONTHS)


def chart_rank_topn(spark: SparkSession, folder: str) -> DataFrame:
    gold_table = _mart(spark, folder, "order_count_by_seller_state_city")
    return charts.rank(gold_table, "seller_city", "total_orders", 10)


def chart_surface(spark: SparkSession, folder: str) -> DataFrame:
    gold_table = _mart(spark, folder, "average_installments_by_payment_type_monthly")
    return charts.surface(gold_table, "year", "month", "payment_type", "average_installments")


def chart_grouped_bar(spark: SparkSession, folder: str) -> DataFrame:
    gold_table = _mart(spark, folder, "order_count_by_state_and_category")
    return charts.grouped_bar(gold_table, "customer_state", CATEGORY, "order_count")


def chart_scatter(spark: SparkSession, folder: str) -> DataFrame:
    gold_table = _mart(spark, folder, "monthly_revenue_summary")
    keys = starmill.spec("monthly_revenue_summary").grain
    return charts.scatter(gold_table, keys, "total_orders", "total_revenue")


def chart_composition(spark: SparkSession, folder: str) -> DataFrame:
    gold_table = _written(spark, folder, "product_weight_summary_by_city")
    return charts.composition(gold_table, "customer_city", "total_weight")


def chart_column_roles(spark: SparkSession, folder: str) -> DataFrame:
    return charts.column_roles(_mart(spark, folder, "monthly_revenue_summary"))


# --- logs --------------------------------------------------------------------------------


def _logs(spark: SparkSession, folder: str) -> DataFrame:
    """Logs made of the documents: a third fails one way, a third the other."""
    path = (
        "concat('containers/application_', source, CASE doc_id % 2 WHEN 0 THEN '/attempt/'"
        " ELSE '/' END, doc_id, '/stdout.gz') AS path"
    )
    text = (
        "CASE doc_id % 3"
        " WHEN 0 THEN concat(text, '\\nTraceback (most recent call last):\\n', text)"
        " WHEN 1 THEN concat(text, '\\npyspark.errors.AnalysisException: ', text)"
        " ELSE text END AS text"
    )
    return warehouse.read(spark, folder, "documents").selectExpr(path, text)


def log_line_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Gzip logs of many documents each: kind, first line and size of each log's failure."""
    starmill.configure(spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    path = starmill.scratch_dir(spark, "logs")
    docs.select(
        F.concat(F.lit("application_"), "source", F.lit("_"), F.col("doc_id") % 7).alias("job"),
        "doc_id",
        F.expr(
            "concat(coalesce(text, ''), CASE WHEN doc_id % 11 = 0 THEN '\nTraceback (most recent call last):'"
            " WHEN doc_id % 5 = 0 THEN '\npyspark.errors.AnalysisException: x' ELSE '' END)"
        ).alias("text"),
    ).repartition("job").sortWithinPartitions("job", "doc_id").drop("doc_id").write.partitionBy(
        "job"
    ).option("compression", "gzip").text(path)
    lines = logs.read_log_lines(spark, path, "*.gz", "application_")
    return logs.failure_lines(lines).groupBy("path", "kind").agg(
        F.min_by("text", "place").alias("first_line"),
        F.count("*").alias("n_lines"),
        F.sum(F.length("text")).alias("n_chars"),
    ).select(
        F.regexp_extract("path", "(application_[^/]+)/", 1).alias("job"),
        "kind", "first_line", "n_lines", "n_chars",
    )


def log_failure_scan(spark: SparkSession, folder: str) -> DataFrame:
    starmill.configure(spark)
    return logs.scan_failures(_logs(spark, folder))


def log_first_failure(spark: SparkSession, folder: str) -> DataFrame:
    """The failure in the log with the shallowest path, over the same logs, by its place."""
    starmill.configure(spark)
    return logs.first_failure(_logs(spark, folder)).select("path", "depth", "kind")


_OPERATORS = (
    scan_bronze_parquet, scan_bronze_csv, scan_bronze_csv_multiline, sink_gold_parquet, sink_gold_partition_overwrite,
    sink_gold_publish, catalog_register_gold, gold_preview, filter_period_in, join_translation_left,
    join_geolocation_zip, star_join, check_acceptance_sql, check_row_predicates, check_not_null,
    check_between, check_in_set, check_rowcount_equals_distinct, check_unique_grain,
    check_reconcile_bronze, check_period_scope, check_spot_value, check_non_empty,
    check_category_allowlist, validation_report, profile_columns, profile_top_values,
    profile_histogram, profile_correlation, profile_smoke, chart_preview_line, chart_rank_topn,
    chart_surface, chart_grouped_bar, chart_scatter, chart_composition, chart_column_roles,
    log_failure_scan, log_first_failure, log_line_failures,
)


def entry(spark: SparkSession) -> DataFrame:
    """Monthly delivered revenue per category over the smallest tables."""
    return _mart(spark, "/root/testdata/sf0.001", "monthly_revenue_summary")


def _comparable(query: Callable, spark: SparkSession, folder: str) -> DataFrame:
    """The query's result; doubles are rounded as in the SQL, which adds them up in another way."""
    df = query(spark, folder)
    return df.withColumns({
        c: F.round(F.col(c) + float(ORACLE_NUDGE), ORACLE_DIGITS)
        for c, kind in df.dtypes if kind == "double"
    })


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {name: partial(_mart, name=name) for name in starmill.mart_names()}
    found.update({f.__name__: f for f in _OPERATORS})
    found = {name: partial(_comparable, query) for name, query in found.items()}
    if llm_queries:
        found.update(llm_queries.queries())
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = dict(ORACLE)
    if llm_queries:
        found.update(llm_queries.oracle_sql())
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
