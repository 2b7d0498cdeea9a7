"""``spark-submit`` entry: build, check and register one mart.

The lake comes from the environment, in variables with fixed names: S3_DATA_BUCKET, S3_BRONZE_PREFIX, S3_GOLD_PREFIX,
BRONZE_FORMAT, and TARGET_TABLE for another name than the mart's own.
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.sql import SparkSession

from starmill.jobs import run_mart
from starmill.plans.registry import mart_names
from starmill.session import release_scratch
from starmill.sources.bronze import LakeConfig


def main() -> int:
    parser = argparse.ArgumentParser(prog="starmill", description=__doc__)
    parser.add_argument("mart", choices=mart_names())
    parser.add_argument("--partition-by", nargs="*", default=[])
    parser.add_argument("--register", action="store_true", help="create the catalog table")
    options = parser.parse_args()
    target = os.environ.get("TARGET_TABLE")
    spark = SparkSession.builder.appName(options.mart).getOrCreate()
    results = run_mart(
        spark,
        LakeConfig.from_env(),
        options.mart,
        run_id=uuid.uuid4().hex,
        target=f"gold.{target.removeprefix('gold.')}" if target else None,
        partition_by=options.partition_by,
        register=options.register,
    ).collect()  # one row per check
    release_scratch(spark)
    for row in results:
        print("ok  " if row.passed else "FAIL", row.check, "-", row.message)
    spark.stop()
    return 0 if all(row.overall_passed for row in results) else 1


if __name__ == "__main__":
    raise SystemExit(main())
