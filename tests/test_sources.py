"""Readers, writers and the catalog."""

import gzip
import os
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import starmill
from starmill import session
from conftest import rows
from starmill.functions import month_label, number_or_zero, parse_ts, quarter_label
from starmill.operators import logs
from starmill.sources import gold, records
from starmill.jobs import run_mart
from starmill.sources.schemas import CSV_FILES
from starmill.sources.bronze import CSV_OPTIONS, LakeConfig, conform, read_bronze, read_tables


@pytest.fixture
def lake(tmp_path):
    folder = tmp_path / "bronze/raw"
    folder.mkdir(parents=True)
    (folder / "olist_orders_dataset.csv").write_text(
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_carrier_date,order_delivered_customer_date,"
        "order_estimated_delivery_date\n"
        "a,c1,delivered,2017-10-02 10:56:33,,,2017-10-10 21:25:13,2017-10-18 00:00:00\n"
        "b,c2,delivered,not a time,,,,\n"
    )
    (folder / "olist_order_reviews_dataset.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,a,4,"so, so","he said ""good""",2018-01-18 00:00:00,2018-01-18 21:46:59\n'
    )
    return LakeConfig(str(tmp_path))


def test_csv_has_declared_types_and_survives_bad_timestamps(spark, lake):
    orders = read_bronze(spark, lake, "olist_orders_raw")
    assert dict(orders.dtypes)["order_purchase_timestamp"] == "timestamp"
    found = {r.order_id: r.order_purchase_timestamp for r in orders.collect()}
    assert str(found["a"]) == "2017-10-02 10:56:33" and found["b"] is None


def test_csv_quotes(spark, lake):
    review = read_bronze(spark, lake, "order_reviews").first()
    assert review.review_comment_title == "so, so"
    assert review.review_comment_message == 'he said "good"'
    assert review.review_score == 4


def test_schema_inference_is_opt_in(spark, lake):
    inferred = read_bronze(spark, lake, "orders", infer_schema=True)
    assert dict(inferred.dtypes)["order_purchase_timestamp"] == "string"
    parsed = inferred.select("order_id", parse_ts("order_purchase_timestamp").alias("ts"))
    assert {r.order_id: r.ts is None for r in parsed.collect()} == {"a": False, "b": True}


def test_parquet_round_trip_and_pushdown(spark, lake, shop):
    for name in ("orders", "order_items", "products", "category_translation"):
        conform(shop[name], name).write.parquet(lake.bronze_path(name, "parquet"))
    parquet = LakeConfig(lake.root, bronze_format="parquet")
    sources = starmill.spec("monthly_revenue_summary").sources
    tables = read_tables(spark, parquet, [f"olist_{s}_raw" for s in sources])
    summary = starmill.build("monthly_revenue_summary", tables)
    assert rows(summary) == rows(starmill.build("monthly_revenue_summary", shop))
    plan = summary._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(order_status,delivered)" in plan
    assert "IsNotNull(price)" in plan
    assert "struct<order_id:string,product_id:string,price:double>" in plan


def test_paths():
    lake = LakeConfig("s3://bucket", "bronze", "gold")
    assert lake.bronze_path("olist_orders_raw").endswith("bronze/olist_orders_dataset.csv")
    assert lake.bronze_path("orders", "parquet") == "s3://bucket/bronze/olist_orders_raw"
    # A table without a known file is read as Parquet.
    assert lake.bronze_path("olist_promotions_raw") == "s3://bucket/bronze/olist_promotions_raw"
    env = {"S3_DATA_BUCKET": "b", "S3_BRONZE_PREFIX": "x", "BRONZE_FORMAT": "Parquet"}
    assert LakeConfig.from_env(env).bronze_path("orders") == "s3://b/x/olist_orders_raw"
    with pytest.raises(ValueError):
        LakeConfig.from_env({})


def test_unknown_sources_fail(spark, lake):
    for table in ("olist_returns_raw", "amazon_brazil_orders_raw"):
        with pytest.raises(AnalysisException):
            read_bronze(spark, lake, table)
    with pytest.raises(ValueError, match="format"):
        read_bronze(spark, lake, "orders", "orc")


def test_only_gold_targets(spark, lake):
    df = spark.range(1)
    for target in ("silver.orders_copy_only", "gold.", "gold.a/b", "orders"):
        with pytest.raises(ValueError, match="gold"):
            gold.write_gold(df, lake, target)


def test_columns_are_asserted_before_anything_is_written(spark, lake, tmp_path):
    with pytest.raises(ValueError, match="differ"):
        gold.write_gold(spark.range(1), lake, "gold.x", {"id": "int"})
    assert not (tmp_path / "gold").exists()


def test_partition_overwrite_keeps_other_partitions(spark, lake):
    first = spark.createDataFrame([(2016, 1), (2017, 2)], "y int, v int")
    second = spark.createDataFrame([(2017, 3)], "y int, v int")
    gold.write_gold(first, lake, "gold.parts", partition_by=["y"])
    path = gold.write_gold(
        second, lake, "gold.parts", partition_by=["y"], replace_partitions=True)
    assert rows(spark.read.parquet(path).select("y", "v")) == [(2016, 1), (2017, 3)]
    path = gold.write_gold(second, lake, "gold.parts", partition_by=["y"])
    assert rows(spark.read.parquet(path).select("y", "v")) == [(2017, 3)]
    path = gold.write_gold(second, lake, "gold.whole")
    assert rows(spark.read.parquet(gold.write_gold(first, lake, "gold.whole"))) == [
        (2016, 1), (2017, 2)
    ]


def test_catalog(spark, lake):
    columns = {"y": "int", "v": "int"}
    df = spark.createDataFrame([(2016, 1), (2017, 2)], "y int, v int")
    path = gold.write_gold(df, lake, "gold.catalog_test", columns)
    assert gold.register_gold(spark, "gold.catalog_test", path, columns).count() == 2
    path = gold.write_gold(df.limit(1), lake, "gold.catalog_other")
    again = gold.register_gold(spark, "gold.catalog_test", path)
    assert again.count() == 1 and dict(again.dtypes) == columns
    parts = gold.write_gold(df, lake, "gold.catalog_parts", partition_by=["y"])
    by_year = gold.register_gold(spark, "gold.catalog_parts", parts, {"v": "int", "y": "int"}, ["y"])
    assert by_year.filter("y = 2017").first().v == 2


@pytest.mark.parametrize("parts", [[], ["y"]], ids=["plain", "partitioned"])
def test_a_failed_publish_leaves_the_old_version(spark, lake, parts):
    columns = {"v": "int", "y": "int"}
    target = f"gold.published_{len(parts)}"

    def version(*values):
        return spark.createDataFrame([(v, 2016 + v) for v in values], "v int, y int")

    def shown():
        return sorted(r.v for r in spark.table(target).collect())

    first = gold.publish_gold(version(1, 2), lake, target, columns, parts)
    assert shown() == [1, 2]
    broken = spark.range(3000, numPartitions=8).selectExpr(
        "cast(if(id < 2999, id, raise_error('midway')) AS int) v", "2016 y")
    with pytest.raises(Exception, match="midway"):
        gold.publish_gold(broken, lake, target, columns, parts)
    assert shown() == [1, 2]
    old = spark.table(target)
    gold.publish_gold(version(3), lake, target, columns, parts)
    assert shown() == [3]
    assert sorted(r.v for r in spark.read.parquet(first).collect()) == [1, 2]
    del old
    gold.publish_gold(version(4, 5), lake, target, columns, parts)
    assert shown() == [4, 5]
    root = first.rsplit("/", 1)[0]
    assert len([p for p in os.listdir(root) if p.startswith(gold.VERSION)]) == 2
    spark.sql(f"DROP TABLE {target}")


def test_an_interrupted_switch_is_taken_up(spark, lake):
    columns = {"v": "int", "y": "int"}
    df = spark.createDataFrame([(1, 2016)], "v int, y int")
    gold.publish_gold(df, lake, "gold.cut", columns, ["y"])
    spark.sql("ALTER TABLE gold.cut RENAME TO gold.cut__former")
    gold.publish_gold(df.selectExpr("v + 1 AS v", "y"), lake, "gold.cut", columns, ["y"])
    assert [r.v for r in spark.table("gold.cut").collect()] == [2]
    assert not spark.catalog.tableExists("gold.cut__former")
    assert not spark.catalog.tableExists("gold.cut__next")


def test_catalog_leaves_managed_tables_alone(spark, lake):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    spark.range(3).write.mode("overwrite").saveAsTable("gold.kept")
    with pytest.raises(ValueError, match="not an external table"):
        gold.register_gold(spark, "gold.kept", lake.gold_path("kept"))
    assert spark.table("gold.kept").count() == 3


def test_preview_is_ordered(spark):
    df = spark.range(100).selectExpr("100 - id AS k", "id AS v")
    assert [r.k for r in gold.preview(df, ["k"], 3).collect()] == [1, 2, 3]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    assert starmill.scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_is_refused_on_a_cluster_without_a_shared_folder():
    class Cluster:
        class conf:
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        starmill.scratch_dir(Cluster, "x")


def test_labels_and_numbers(spark):
    df = spark.createDataFrame([(2017, 3, "1.5"), (987, 12, "bad"), (None, 1, None)], "y int, m int, v string")
    found = df.select(month_label("y", "m"), quarter_label("y", "m"), number_or_zero("v")).collect()
    assert [tuple(r) for r in found] == [
        ("2017-03", "2017-Q3", 1.5), ("0987-12", "0987-Q12", 0.0), ("unknown", "unknown", 0.0)
    ]


def test_log_lines(spark, conf, tmp_path):
    """Lines from the marker on, of packed logs and of plain ones that many tasks read."""
    conf(spark__sql__files__maxPartitionBytes="256", spark__sql__files__openCostInBytes="1")
    head = [f"line {i} of the log" for i in range(200)]
    bodies = {
        "a/stdout.gz": [*head, "AnalysisException: early", *head, "x Traceback (most recent call last):", *head],
        "b/c/stdout.gz": [*head, "an AnalysisException: é", "last"],
        "d/stdout.gz": head,
    }
    for name, body in bodies.items():
        target = tmp_path / "application_1" / name
        target.parent.mkdir(parents=True, exist_ok=True)
        text = "\n".join(body).encode()
        target.write_bytes(gzip.compress(text))
        target.with_name("plain").write_bytes(text)
    want = {"a": bodies["a/stdout.gz"][401:], "b/c": bodies["b/c/stdout.gz"][200:]}
    for name in ("stdout.gz", "plain"):
        lines = logs.read_log_lines(spark, str(tmp_path), name)
        found = {r.path.split("application_1/")[1]: r for r in logs.find_failures(lines).collect()}
        assert {k: r.kind for k, r in found.items()} == {f"a/{name}": "traceback", f"b/c/{name}": "analysis"}
        assert found[f"b/c/{name}"].depth == found[f"a/{name}"].depth + 1
        texts = {}
        for r in logs.failure_lines(lines).orderBy("path", "place").collect():
            texts.setdefault(r.path.split("application_1/")[1].removesuffix(f"/{name}"), []).append(r.text)
        assert texts == want


def test_log_files(spark, tmp_path):
    def put(path, text):
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(gzip.compress(text.encode()))

    trace = "x\nTraceback (most recent call last):\n" + "é" * 9000
    put("application_1/b/c/stdout.gz", trace)
    put("application_1/stdout.gz", "all is well" * 1000)
    put("application_1/b/stdout.gz", "y" * 300 + "AnalysisException: no column" + "z" * 5000)
    put("application_1/stderr.gz", trace)
    put("elsewhere/stdout.gz", trace)
    read = logs.read_logs(spark, str(tmp_path))
    found = {r.path.split("/application_1/")[1]: r for r in logs.scan_failures(read).collect()}
    assert set(found) == {"b/c/stdout.gz", "stdout.gz", "b/stdout.gz"}
    assert found["b/c/stdout.gz"].excerpt == trace[2:]
    assert found["b/c/stdout.gz"].tail == trace
    assert found["stdout.gz"].kind is None and found["stdout.gz"].excerpt is None
    text = "y" * 300 + "AnalysisException: no column" + "z" * 5000
    assert found["b/stdout.gz"].excerpt == text[300:]
    cut = logs.scan_failures(read, before=200, after=4000, tail=10).filter("kind = 'analysis'")
    assert [(r.excerpt, r.tail) for r in cut.collect()] == [(text[100:4300], "z" * 10)]
    first = logs.first_failure(logs.read_logs(spark, str(tmp_path))).collect()
    assert [r.kind for r in first] == ["analysis"]


def test_short_log_and_early_word(spark):
    df = spark.createDataFrame([
        ("p", "ab AnalysisException"),
        ("q", "Traceback word, then Traceback (most recent call last): boom"),
        ("r", "Traceback alone"),
    ], "path string, text string")
    found = {r.path: (r.kind, r.excerpt) for r in logs.scan_failures(df).collect()}
    assert found == {
        "p": ("analysis", "AnalysisException"),
        "q": ("traceback", "Traceback (most recent call last): boom"),
        "r": (None, None),
    }


def test_job_from_csv_to_checked_gold(spark, tmp_path, shop):
    lake = LakeConfig(str(tmp_path))
    for name in starmill.spec("monthly_revenue_summary").sources:
        conform(shop[name], name).write.options(**CSV_OPTIONS).csv(lake.bronze_path(name))
    audit = run_mart(spark, lake, "monthly_revenue_summary", "run-1", register=True)
    found = audit.collect()
    assert len(found) == 5 and all(r.passed and r.overall_passed for r in found)
    assert rows(spark.table("gold.monthly_revenue_summary")) == rows(
        starmill.build("monthly_revenue_summary", shop))
    again = run_mart(spark, lake, "monthly_revenue_summary", "run-2", target="gold.other",
                     partition_by=["order_year"])
    assert {r.run_id for r in again.collect()} == {"run-2"}
    assert (tmp_path / "gold/other/order_year=2017").is_dir()


def test_job_reports_a_broken_mart(spark, tmp_path, shop):
    lake = LakeConfig(str(tmp_path), bronze_format="parquet")
    conform(shop["orders"], "orders").write.parquet(lake.bronze_path("orders"))
    failed = run_mart(spark, lake, "order_delivery_sla", "r").filter("NOT passed").collect()
    assert [r.check for r in failed] == ["between: delivery_days"]  # delivered before bought
    assert not failed[0].overall_passed


def test_csv_columns_are_found_by_name(spark, lake, tmp_path):
    path = tmp_path / "items.csv"
    header = "order_id,order_item_id,product_id,seller_id,shipping_limit_date,freight_value,price"
    path.write_text(header + "\no1,1,p,s,2017-01-02 03:04:05,2.5,10.0\n")
    csv = LakeConfig(str(tmp_path), bronze_prefix="b")
    target = tmp_path / "b" / CSV_FILES["order_items"]
    target.parent.mkdir()
    path.rename(target)
    row = read_bronze(spark, csv, "order_items").first()
    assert (row.price, row.freight_value, row.shipping_limit_date.year) == (10.0, 2.5, 2017)
    target.write_text("order_id,amount\no1,3\n")
    with pytest.raises(ValueError, match="lacks"):
        read_bronze(spark, csv, "order_items")


def test_csv_fields_may_hold_line_breaks(spark, tmp_path):
    target = tmp_path / "b" / CSV_FILES["order_reviews"]
    target.parent.mkdir()
    header = ("review_id,order_id,review_score,review_comment_title,review_comment_message,"
              "review_creation_date,review_answer_timestamp")
    target.write_text(
        header + '\nr1,o1,4,,"two\nlines, ""quoted""",2017-01-02,\nr2,o2,bad,t,m,nonsense,\n')
    found = read_bronze(spark, LakeConfig(str(tmp_path), bronze_prefix="b"), "order_reviews")
    first, second = sorted(found.collect(), key=lambda r: r.review_id)
    assert first.review_comment_message == 'two\nlines, "quoted"' and first.review_score == 4
    assert (second.review_score, second.review_creation_date) == (None, None)


def _odd_csv(path, rng, rows, end):
    """A CSV file with quoted breaks, quotes and commas, blank lines and ragged rows."""
    parts = ["a", "é", " ", ",", "\n", "\r\n", '""', "x" * 40, ";", "\n\n", "中"]
    lines = ["id,title,text"]
    for i in range(rows):
        title = "".join(rng.choice(parts) for _ in range(rng.randint(0, 6)))
        kind = rng.randrange(6)
        lines.append({
            0: f'{i},plain,', 1: f'{i},"{title}","{title}{i}"', 2: f'{i},"",', 3: f'{i},"{title}"',
            4: f'"{i}","{title}\n","one, two"', 5: f'{i},a b c,"{"line" + chr(10)}"',
        }[kind])
        if rng.random() < 0.05:
            lines.append("")
    path.write_bytes((end.join(lines) + rng.choice(["", end])).encode())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_quoted_breaks_across_many_ranges(spark, conf, tmp_path, end):
    """Byte ranges of 512 bytes give what one task reads."""
    rng = random.Random(11)
    for number in range(3):
        _odd_csv(tmp_path / f"part{number}.csv", rng, 400, end)
    options = {"quote": '"', "escape": '"'}
    whole = spark.read.options(header="true", multiLine="true", **options).csv(str(tmp_path))
    want = sorted(whole.collect(), key=str)
    conf(spark__sql__files__maxPartitionBytes="512", spark__sql__files__openCostInBytes="1")
    found = records.read_csv(spark, str(tmp_path), **options)
    assert found.columns == whole.columns
    assert sorted(found.collect(), key=str) == want
    assert len(want) == 1200
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 30


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_pieces_of_a_range_are_sorted_apart(spark, monkeypatch, tmp_path, end):
    """Pieces of a few lines give what one task reads, also where the first ones are blank."""
    monkeypatch.setattr(records, "PIECE", 4)
    rng = random.Random(12)
    for number in range(2):
        _odd_csv(tmp_path / f"part{number}.csv", rng, 200, end)
    late = tmp_path / "late.csv"
    late.write_bytes(end.encode() * 11 + (tmp_path / "part0.csv").read_bytes())
    options = {"quote": '"', "escape": '"'}
    whole = spark.read.options(header="true", multiLine="true", **options).csv(str(tmp_path))
    found = records.read_csv(spark, str(tmp_path), **options)
    assert sorted(found.collect(), key=str) == sorted(whole.collect(), key=str)
    lines = records._lines(spark, str(tmp_path), '"')
    assert lines.groupBy(*records.RANGE).count().agg({"count": "max"}).first()[0] <= 4


def test_unpaired_quotes_are_read_whole(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,text\n1,5" tall\n2,b\n')
    options = {"quote": '"', "escape": '"'}
    assert records.read_records(spark, str(tmp_path)) is None
    found = records.read_csv(spark, str(tmp_path), **options)
    whole = spark.read.options(header="true", multiLine="true", **options).csv(str(tmp_path))
    assert found.collect() == whole.collect()
    assert records.read_csv(spark, str(tmp_path), quote='"', escape="\\").columns == ["id", "text"]


def test_parquet_types_are_read_as_declared(spark, tmp_path):
    lake = LakeConfig(str(tmp_path), bronze_prefix="b", bronze_format="parquet")
    spark.createDataFrame(
        [("o1", "2017-05-06 07:08:09"), ("o2", "not a time")],
        "order_id string, order_purchase_timestamp string",
    ).write.parquet(lake.bronze_path("orders"))
    found = {r.order_id: r.order_purchase_timestamp for r in
             read_bronze(spark, lake, "orders").collect()}
    assert found["o1"].month == 5 and found["o2"] is None
    spark.createDataFrame(
        [("o1", 1, "boleto", 3, 1.5), ("o2", 2, "boleto", 2**40, 2.5)],
        "order_id string, payment_sequential bigint, payment_type string,"
        " payment_installments bigint, payment_value double",
    ).write.parquet(lake.bronze_path("order_payments"))
    table = read_bronze(spark, lake, "order_payments")
    assert dict(table.dtypes)["payment_installments"] == "int"
    assert rows(table.select("order_id", "payment_installments")) == [("o1", 3), ("o2", None)]


def test_partition_values_keep_their_type(spark, lake):
    df = spark.createDataFrame([("007", 1), ("08", 2)], "k string, v int")
    path = gold.write_gold(df, lake, "gold.texts", partition_by=["k"])
    assert rows(gold.read_gold(spark, path, {"k": "string", "v": "int"})) == [("007", 1), ("08", 2)]


def test_scratch_folders_are_released(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_scratch_root", lambda spark: str(tmp_path / "shared"))
    monkeypatch.setattr(session, "_written", {})
    kept = [session.stored(spark.range(3), "x") for _ in range(2)]
    assert len(list((tmp_path / "shared").iterdir())) == 2 and kept[0].count() == 3
    assert session.release_scratch(spark) == 2
    assert not list((tmp_path / "shared").iterdir())
    assert session.release_scratch(spark) == 0


def test_a_local_session_has_one_folder(monkeypatch):
    class Local:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master, applicationId = "local[2]", "app-of-this-test"

    monkeypatch.setattr(session, "_local_roots", {})
    first, second = (starmill.scratch_dir(Local, "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
