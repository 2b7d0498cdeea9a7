"""One mart from raw tables to a checked gold table, as a batch job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.checks import append_audit, mart_checks, read_audit, validation_report
from starmill.plans.registry import build, spec
from starmill.session import configure
from starmill.sources.bronze import LakeConfig, read_tables
from starmill.sources.gold import publish_gold, read_gold, write_gold

AUDIT = "validation_audit"


def run_mart(
    spark: SparkSession,
    lake: LakeConfig,
    name: str,
    run_id: str,
    target: str | None = None,
    partition_by: Sequence[str] = (),
    register: bool = False,
    **args,
) -> DataFrame:
    """Read the mart's sources, write it, check what was written; returns the audit rows."""
    configure(spark)
    chosen = spec(name)
    target = target or chosen.target_table
    mart = build(name, read_tables(spark, lake, chosen.sources), **args)
    if register:
        path = publish_gold(mart, lake, target, chosen.columns, partition_by)
    else:
        path = write_gold(mart, lake, target, chosen.columns, partition_by)
    table = read_gold(spark, path, chosen.columns)
    report = validation_report({"error": mart_checks(table, chosen)})
    audit = append_audit(report, lake.gold_path(AUDIT), run_id)
    return read_audit(spark, audit).filter(F.col("run_id") == run_id)
