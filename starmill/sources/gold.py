"""Writing, registering and previewing gold tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.sources.bronze import LakeConfig

GOLD_PREFIX = "gold."
VERSION = "version-"


def gold_name(target: str) -> str:
    """``gold.x`` -> ``x``; any other target is refused."""
    if not target.startswith(GOLD_PREFIX) or not target[len(GOLD_PREFIX):].isidentifier():
        raise ValueError(f"target table must start with {GOLD_PREFIX!r}: {target!r}")
    return target[len(GOLD_PREFIX):]


def assert_columns(df: DataFrame, columns: Mapping[str, str]) -> None:
    """Raise unless ``df`` has exactly these columns and types, in this order."""
    actual = dict(df.dtypes)
    if list(actual.items()) != list(columns.items()):
        raise ValueError(f"gold columns {actual} differ from the declared {dict(columns)}")


def write_gold(
    df: DataFrame,
    lake: LakeConfig,
    target: str,
    columns: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    replace_partitions: bool = False,
) -> str:
    """Write one gold table as Parquet and return its path.

    An overwrite replaces the whole table; with ``replace_partitions`` it replaces only the
    partitions that ``df`` holds, and leaves the others as they are.
    """
    path = lake.gold_path(gold_name(target))
    if columns is not None:
        assert_columns(df, columns)
    if partition_by:
        # Few files per partition; AQE cuts a hot partition into several tasks.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        kind = "dynamic" if replace_partitions else "static"
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", kind)
    writer.parquet(path)
    return path


def read_gold(spark: SparkSession, path: str, columns: Mapping[str, str]) -> DataFrame:
    """A gold table with its declared types; partition values keep theirs ("007" stays text)."""
    schema = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    return spark.read.schema(schema).parquet(path).select(*columns)


def register_gold(
    spark: SparkSession,
    target: str,
    path: str,
    columns: Mapping[str, str] | None = None,
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Create or replace the external catalog table of a gold folder; returns the table.

    Without ``columns`` the schema comes from the Parquet footers.
    """
    name = gold_name(target)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {GOLD_PREFIX[:-1]}")
    if spark.catalog.tableExists(f"{GOLD_PREFIX}{name}"):
        if spark.catalog.getTable(f"{GOLD_PREFIX}{name}").tableType != "EXTERNAL":
            raise ValueError(f"{target} exists and is not an external table; it is left alone")
        spark.sql(f"DROP TABLE {GOLD_PREFIX}{name}")
    listed = ""
    if columns:
        listed = "(" + ", ".join(f"`{c}` {t}" for c, t in columns.items()) + ")"
    parts = f"PARTITIONED BY ({', '.join(partition_by)})" if columns and partition_by else ""
    spark.sql(f"CREATE TABLE {GOLD_PREFIX}{name} {listed} USING parquet {parts} LOCATION '{path}'")
    if parts:
        spark.catalog.recoverPartitions(f"{GOLD_PREFIX}{name}")
    return spark.table(f"{GOLD_PREFIX}{name}")


def publish_gold(
    df: DataFrame,
    lake: LakeConfig,
    target: str,
    columns: Mapping[str, str],
    partition_by: Sequence[str] = (),
    keep: int = 2,
) -> str:
    """Replace a registered gold table as a whole, or not at all; returns the new version's path.

    Every version is a folder of its own below the table's. The catalog table points to it only
    after the write has ended, so a write that fails leaves the old version as it was, and readers
    of the old one are not disturbed. The newest ``keep`` complete versions stay; what failed writes
    left behind goes.
    """
    spark, name = df.sparkSession, gold_name(target)
    assert_columns(df, columns)
    root = lake.gold_path(name)
    path = f"{root}/{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.option("compression", "snappy").partitionBy(*partition_by).parquet(path)
    _point(spark, name, path, columns, partition_by)
    _drop_versions(spark, root, path, keep)
    return path


def _point(
    spark: SparkSession, name: str, path: str, columns: Mapping[str, str], partition_by: Sequence[str]
) -> None:
    """Let the catalog table show the folder, by one change of the catalog where that is possible."""
    table, following, former = (f"{GOLD_PREFIX}{name}{suffix}" for suffix in ("", "__next", "__former"))
    exists = spark.catalog.tableExists
    if not exists(table) and exists(former):  # a switch that was cut short
        spark.sql(f"ALTER TABLE {former} RENAME TO {table}")
    if not exists(table):
        register_gold(spark, table, path, columns, partition_by)
        return
    found = spark.catalog.getTable(table)
    if found.tableType != "EXTERNAL":
        raise ValueError(f"{table} exists and is not an external table; it is left alone")
    if dict(spark.table(table).dtypes) == dict(columns) and not partition_by and not any(
        c.isPartition for c in spark.catalog.listColumns(table)
    ):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
        return
    # Partitions have places of their own in the catalog, so a complete table takes over the name.
    register_gold(spark, following, path, columns, partition_by)
    spark.sql(f"DROP TABLE IF EXISTS {former}")
    spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {following} RENAME TO {table}")
    spark.sql(f"DROP TABLE {former}")


def _drop_versions(spark: SparkSession, root: str, current: str, keep: int) -> None:
    """Delete versions beside the current one: failed ones, and complete ones beyond the newest."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    files = hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(
        (s.getPath().getName() for s in files.listStatus(hadoop.Path(root))
         if s.getPath().getName().startswith(VERSION)), reverse=True,
    )
    newest = current.rsplit("/", 1)[1]
    older = [n for n in names if n < newest]  # a later one may be being written
    complete = [n for n in older if files.exists(hadoop.Path(f"{root}/{n}/_SUCCESS"))]
    for gone in set(older) - set(complete[:keep - 1]):
        files.delete(hadoop.Path(f"{root}/{gone}"), True)


def preview(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in key order."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys]).limit(n)
