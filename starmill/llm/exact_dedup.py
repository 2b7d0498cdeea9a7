"""Exact dedup: a stateful stream over content digests, checked by full bytes on hits.

1. Arrivals. Every row becomes (digest, stable id, content locator), written to the shared folder.
   The locator is the data file and the row's index in it; it is stable across retries. Texts are
   not copied.
2. State. A stream over the arrivals keeps one entry per digest in RocksDB, which lives on disk and
   has no expiry: the row that stays so far (largest id, then largest locator), and the group's
   size. State and progress lie in the shared folder, so a lost executor's partitions reload there,
   and a later run may go on from the same folder with more arrivals. Partial aggregation reduces a
   group of copies to one row per task before the shuffle.
3. Byte check. Rows whose digest was hit before are grouped again by digest and whole text; a hash
   map's key comparison reads all bytes. Such rows are found by a bitmap over the digests, ``SPREAD``
   bits for each hit up to ``SLOTS`` in all, so only their texts (and few others) are shuffled; a full
   bitmap costs work, not results. Where a digest turns out to hold different texts, the groups by text
   replace the group by digest.

Defined results: null texts count as empty; all empty texts form one group. Null ids sort below all
others. Of repeated rows (same id and text) exactly one is kept, that of the largest locator. Empty
tables give empty results. Extra columns are ignored here and pass through ``keep_one``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmill.llm.common import free_names, named
from starmill.session import scratch_dir, stored

# State on disk; without fallocate, since each of many small stores would reserve megabytes, and with
# one bound on the native memory of all stores of an executor.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
}
SPREAD, SLOTS = 16, 1 << 27
ARRIVALS = "digest string, doc_id long, file string, row long"


def located(documents: DataFrame, *names: str) -> DataFrame:
    """``documents`` with the file and row index of every row under the two given names.

    A frame that does not read files directly is written to the shared folder first.
    """
    file, row = names

    def add(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {file: F.col("_metadata.file_path"), row: F.col("_metadata.row_index")}
        )

    clash = "_metadata" in {c.lower() for c in documents.columns}
    try:
        if not clash:
            return add(documents)
    except AnalysisException:
        pass
    back = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    plain = stored(documents.toDF(*back.values()), "dedup-input")
    return add(plain).select(*[F.col(v).alias(k) for k, v in back.items()], file, row)


def digest_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _order() -> Column:
    """Ids as numbers that compare like them, null lowest, then the locator."""
    return F.struct(
        F.col("doc_id").isNotNull().alias("known"), F.col("doc_id"), F.col("file"), F.col("row")
    )


def seen_state(spark: SparkSession, arrivals: str, folder: str) -> DataFrame:
    """Stream the arrivals stored at one path; one row per digest from the state in ``folder``."""
    before = {key: spark.conf.get(key, None) for key in STATE_SETTINGS}
    for key, value in STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        query = (
            spark.readStream.schema(ARRIVALS).parquet(arrivals)
            .groupBy("digest")
            .agg(F.max(_order()).alias("keep"), F.count("*").alias("group_size"))
            .writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", folder)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    state = spark.read.format("statestore").load(folder)
    # The state names its aggregates as it likes; one is a struct, the other a number.
    value = {isinstance(f.dataType, T.StructType): f"value.`{f.name}`"
             for f in state.schema["value"].dataType.fields if f.name != "digest"}
    keep, size = value[True], value[False]
    return state.select(
        F.col("key.digest").alias("digest"),
        F.col(keep).alias("keep"),
        F.col(size).alias("group_size"),
    )


def _of_hits(rows: DataFrame, hits: DataFrame) -> DataFrame:
    """``digest, text`` of all rows whose digest is one of the hits, and of few others."""
    slots = min(max(1 << (SPREAD * hits.count()).bit_length(), 1 << 15), SLOTS)
    slot = F.pmod(F.xxhash64("digest"), F.lit(slots))
    bits = hits.select(slot.alias("slot")).groupBy(F.expr("slot div 32768").alias("part")).agg(
        F.bitmap_construct_agg(F.expr("slot % 32768")).alias("bits")
    )
    byte = F.conv(F.hex(F.expr("substring(bits, slot % 32768 div 8 + 1, 1)")), 16, 10).cast("int")
    # At most SLOTS / 32768 rows of four kilobytes.
    return (
        rows.select("digest", "text", slot.alias("slot"))
        .join(F.broadcast(bits), F.expr("slot div 32768") == F.col("part"))
        .filter(byte.bitwiseAND(F.expr("shiftleft(1, cast(slot % 8 AS int))")) != 0)
        .select("digest", "text")
    )


def decide(rows: DataFrame, file: str, row: str, doc_id: str, text: str) -> DataFrame:
    """``decisions`` for rows whose locator is in the columns ``file`` and ``row``."""
    spark = rows.sparkSession
    rows = rows.select(
        digest_of(named(rows, text)).alias("digest"),
        named(rows, doc_id).cast("long").alias("doc_id"),
        named(rows, file).alias("file"),
        named(rows, row).alias("row"),
        F.coalesce(named(rows, text), F.lit("")).alias("text"),
    )
    path = scratch_dir(spark, "dedup-arrivals")
    rows.drop("text").write.parquet(path)
    arrivals = spark.read.schema(ARRIVALS).parquet(path)
    state = stored(seen_state(spark, path, scratch_dir(spark, "dedup-state")), "dedup-seen")

    # Full bytes: a digest with two or more texts shows up as two or more groups here.
    texts = _of_hits(rows, state.filter("group_size > 1").select("digest")).distinct()
    collided = stored(
        texts.groupBy("digest").count().filter("count > 1").select("digest"), "dedup-collided"
    )
    clean = arrivals.join(state, "digest")
    if not collided.isEmpty():
        # Practically never: two texts of one SHA-256. Their rows take the groups by text.
        own = rows.join(collided, "digest", "left_semi")
        groups = own.groupBy("digest", "text").agg(
            F.max(_order()).alias("keep"), F.count("*").alias("group_size")
        )
        clean = clean.join(collided, "digest", "left_anti").unionByName(
            own.join(groups, ["digest", "text"]).drop("text")
        )
    return clean.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.struct("file", "row") == F.struct("keep.file", "keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
        F.col("file").alias("file"),
        F.col("row").alias("row"),
    )


def decisions(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: keep_id, group_size, kept, text_sha256, and the row's locator."""
    file, row = free_names(documents, "file", "row")
    return decide(located(documents, file, row), file, row, doc_id, text)


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``documents`` with one row of each group of equal texts."""
    file, row = free_names(documents, "dedup_file", "dedup_row")
    rows = located(documents, file, row)
    dropped = decide(rows, file, row, doc_id, text).filter("NOT kept").select(
        F.col("file").alias(file), F.col("row").alias(row)
    )
    kept = rows.join(stored(dropped, "dedup-dropped"), [file, row], "left_anti")
    return kept.select(*[named(kept, c) for c in documents.columns])
