"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# AQE re-plans joins from real sizes: it broadcasts a side only after measuring it, and splits
# the partition of a hot join key. The "force" switch lets it split even where the join's
# partitioning would otherwise have been reused by the next aggregate. Rows of one key compress
# well, so the size from which a partition counts as hot is a quarter of Spark's default.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.session.timeZone": "UTC",
}

WRITERS = 4  # tasks per core that write a table of narrow rows

_local_roots: dict[str, str] = {}
_written: dict[str, list[str]] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that the plans in this package rely on, for all of this session's queries.

    The readers, operators and marts work without them; the batch job, the registered queries and
    the tests call this, and a user who keeps other settings need not.
    """
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names; a local session may have one of its own."""
    root, local = spark.conf.get("spark.checkpoint.dir", None), _is_local(spark)
    if root:
        return root.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="run-")
    return _local_roots[app]


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.split("[")[0] == "local"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """The path of a new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of this machine: on a cluster the
    executors could not see it. ``release_scratch`` deletes what was written there.
    """
    path = f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete this application's scratch folders, when nothing reads them any more."""
    paths = _written.pop(spark.sparkContext.applicationId, [])
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    deleted = 0
    for path in paths:
        where = hadoop.Path(path)
        deleted += bool(where.getFileSystem(conf).delete(where, True))
    return deleted


def stored(df: DataFrame, label: str, narrow: bool = False) -> DataFrame:
    """Write ``df`` to the scratch folder now and read it from there.

    For results that several branches of a plan need: each branch prunes columns in its own
    way, so Spark would often compute them once per branch.

    ``narrow`` rows, of a few numbers each, are written by ``WRITERS`` tasks per core at most: a task and
    a file for each of many shuffle partitions would hold less than the driver keeps of them.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(WRITERS * spark.sparkContext.defaultParallelism)
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release_finished(spark: SparkSession) -> None:
    """Let Spark drop the broadcasts and shuffle files of finished queries.

    It does so only when the driver collects its garbage, which many small queries do not bring about.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
