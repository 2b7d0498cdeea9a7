"""Reading raw tables from Parquet folders or CSV files."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions import parse_ts
from starmill.sources import records
from starmill.sources.schemas import BRONZE, CSV_FILES, entity_name, raw_table_name

# Quotes inside a quoted CSV field are doubled.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
# Tables whose quoted fields hold line breaks.
MULTILINE = ("order_reviews",)


@dataclass(frozen=True)
class LakeConfig:
    """Where raw and gold tables live. ``root`` is a bucket or folder URI."""

    root: str
    bronze_prefix: str = "bronze/raw"
    gold_prefix: str = "gold"
    bronze_format: str = "csv"

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> LakeConfig:
        bucket = env.get("S3_DATA_BUCKET", "")
        if not bucket:
            raise ValueError("S3_DATA_BUCKET is not set")
        return cls(
            root=bucket if "/" in bucket else f"s3://{bucket}",
            bronze_prefix=env.get("S3_BRONZE_PREFIX", cls.bronze_prefix),
            gold_prefix=env.get("S3_GOLD_PREFIX", cls.gold_prefix),
            bronze_format=env.get("BRONZE_FORMAT", cls.bronze_format).lower(),
        )

    def bronze_path(self, table: str, fmt: str | None = None) -> str:
        entity = entity_name(table)
        name = raw_table_name(entity)
        if (fmt or self.bronze_format) == "csv" and entity in CSV_FILES:
            name = CSV_FILES[entity]
        return f"{self.root.rstrip('/')}/{self.bronze_prefix.strip('/')}/{name}"

    def gold_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.gold_prefix.strip('/')}/{name}"


def read_bronze(
    spark: SparkSession,
    lake: LakeConfig,
    table: str,
    fmt: str | None = None,
    infer_schema: bool = False,
    **csv_options: str,
) -> DataFrame:
    """One raw table with its declared columns and types, whatever types the files have.

    Columns are found by name. Times kept as text are parsed and numbers are cast; a value that
    cannot be read as its type is null. A CSV file must have every declared column in its header;
    columns that a Parquet file lacks are null. A table without a known CSV file is read as
    Parquet, and one that is not declared as it is. ``infer_schema`` leaves a CSV file's columns
    as they are found, with inferred types, at the cost of one more pass. Reviews, whose fields
    hold line breaks, are read by many tasks (``records``), unless types are inferred.
    """
    entity = entity_name(table)
    fmt = (fmt or lake.bronze_format).lower()
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unknown bronze format {fmt!r}")
    path = lake.bronze_path(entity, fmt)
    if fmt == "parquet" or entity not in CSV_FILES:
        found = spark.read.parquet(path)
        return conform(found, entity) if entity in BRONZE else found
    options = {**CSV_OPTIONS, "inferSchema": str(infer_schema).lower(), **csv_options}
    if entity not in MULTILINE:
        found = spark.read.options(**options).csv(path)
    elif infer_schema:
        found = spark.read.options(**options, multiLine="true").csv(path)
    else:
        found = records.read_csv(spark, path, **options)
    if infer_schema or entity not in BRONZE:
        return found
    missing = [c for c, _ in declared(entity) if c not in found.columns]
    if missing:
        raise ValueError(f"the header of {path} lacks {missing}")
    return conform(found, entity)


def read_tables(
    spark: SparkSession, lake: LakeConfig, names: Iterable[str]
) -> dict[str, DataFrame]:
    return {entity_name(n): read_bronze(spark, lake, n) for n in names}


def declared(table: str) -> list[tuple[str, str]]:
    """Names and types of a raw table's columns."""
    parts = BRONZE[entity_name(table)].split(",")
    return [tuple(part.strip().split(" ")) for part in parts]


def conform(df: DataFrame, table: str) -> DataFrame:
    """The columns and types of a raw table; columns that ``df`` lacks are null.

    A column that has its type already stays as it is, so that filters on it reach the scan.
    """
    kinds = dict(df.dtypes)

    def column(name: str, kind: str) -> Column:
        if name not in kinds:
            return F.lit(None).cast(kind)
        if kinds[name] == kind:
            return F.col(name)
        if kind == "timestamp" and kinds[name] == "string":
            return parse_ts(name)
        return F.col(name).cast(kind) if kind == "string" else F.col(name).try_cast(kind)

    return df.select(*[column(c, t).alias(c) for c, t in declared(table)])
