"""Small helpers shared by the operators."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FOLDS = 5


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Each name, with underscores before it until no column of ``df`` has it in any case."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found


def named(df: DataFrame, column: str) -> Column:
    """The column of exactly this name, whatever other cases or characters ``df`` holds."""
    return df[f"`{column}`"]


def learning_fold(doc_id: Column) -> Column:
    """0 for held-out documents, 1 to 4 for those that may be learned from; null ids are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS, F.lit(0))


def small_batches(spark: SparkSession) -> None:
    """Send texts to Python few at a time from now on, where the session sends more.

    Buffers of whole batches, in the executor and in each of its Python workers, are what an executor
    with many stages behind it has least room for.
    """
    for key, most in (("maxRecordsPerBatch", 512), ("maxBytesPerBatch", 4 << 20)):
        name = f"spark.sql.execution.arrow.{key}"
        given = (spark.conf.get(name, None) or "").removesuffix("b")
        if not given.lstrip("-").isdigit() or not 0 < int(given) <= most:
            spark.conf.set(name, str(most))


def short_plans(spark: SparkSession, most: int = 8 << 10) -> None:
    """Keep the first ``most`` characters of each plan's text from now on, where the session keeps more.

    Spark holds the texts of the last thousand queries in the driver, and writes one anew whenever a stage
    of a query ends. Plans, their metrics and results are the same.
    """
    name = "spark.sql.maxPlanStringLength"
    given = (spark.conf.get(name, None) or "").removesuffix("b")
    if not given.isdigit() or int(given) > most:
        spark.conf.set(name, str(most))


def no_listings(spark: SparkSession) -> None:
    """Keep no list of the files of folders that are read from now on.

    Spark holds these in the driver for the whole session, up to 250 MB, and a scratch table is read by
    the DataFrame that listed it only. Catalog tables, too, are then listed by each query that reads them.
    """
    name = "spark.sql.hive.filesourcePartitionFileCacheSize"
    if spark.conf.get(name, None) != "0":
        spark.conf.set(name, "0")


def text_batches(
    batches: Iterable, column: str = "text", rows: int = 512
) -> Iterable[tuple[object, list[str]]]:
    """Arrow batches with their texts as Python strings, few rows at a time; null counts as empty."""
    for whole in batches:
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            yield batch, [text or "" for text in batch.column(column).to_pylist()]


def same(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "left") -> DataFrame:
    """Join on equal columns, where null equals null; the left side's columns are kept."""
    names = list(names)
    other = right.withColumnsRenamed({n: f"_of_{n}" for n in names})
    match = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_of_{n}")) for n in names])
    return left.join(other, match, how).drop(*[f"_of_{n}" for n in names])


def ordered_sha256(
    df: DataFrame, keys: Sequence[str], order: str, pieces: str, separator: str, name: str
) -> DataFrame:
    """The keys and, as ``name``, the SHA-256 of each group's non-null pieces in order, joined.

    A digest is sequential, so one task reads a group, but it streams: only the digest so far is
    held. Join neighbouring pieces beforehand, so that a hot group is few rows.
    """
    keys = list(keys)
    narrow = df.filter(F.col(pieces).isNotNull()).select(*keys, order, pieces)
    between = separator.encode()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest = None, None
        for batch in batches:
            done: list[tuple] = []
            columns = [batch.column(k).to_pylist() for k in keys]
            for *key, piece in zip(*columns, batch.column(pieces).to_pylist()):
                if digest is None or key != current:
                    if digest is not None:
                        done.append((*current, digest.hexdigest()))
                    current, digest = key, hashlib.sha256()
                else:
                    digest.update(between)
                digest.update(piece.encode())
            yield from made(done)
        if digest is not None:
            yield from made([(*current, digest.hexdigest())])

    fields = [narrow.schema[k] for k in keys]
    schema = StructType(fields).add(name, "string")
    kinds = [k.jsonValue()["type"] for k in fields]
    arrow = {"long": pa.int64(), "integer": pa.int32(), "short": pa.int16(), "byte": pa.int8(),
             "string": pa.string(), "binary": pa.binary()}
    types = [*[arrow[k] for k in kinds], pa.string()]

    def made(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], [*keys, name]
            )

    placed = narrow.repartition(*keys).sortWithinPartitions(*keys, order)
    return placed.mapInArrow(run, schema)
