"""Finding the failure in many job logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a failed driver prints, and the folders of the jobs' logs.
TRACEBACK = "Traceback (most recent call last)"
ANALYSIS = "AnalysisException"
APPLICATION = "application_"


def read_logs(spark: SparkSession, path: str, name: str = "stdout.gz") -> DataFrame:
    """(path, text) of every application log of that name below ``path``; gzip is unpacked."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True, pathGlobFilter=name)
    logs = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return logs.filter(F.col("path").contains(f"/{APPLICATION}"))


def read_log_lines(
    spark: SparkSession, path: str, name: str = "stdout.gz", folder: str = f"/{APPLICATION}"
) -> DataFrame:
    """(path, place, text) of every line of the logs of that name below ``path``.

    ``place`` orders the lines of a log: its byte range, then the line in it. No log is a row as a
    whole, so its size does not matter; a gzip file is still unpacked by one task.
    """
    lines = spark.read.text(path, lineSep="\n", recursiveFileLookup=True, pathGlobFilter=name)
    return lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
        F.col("value").alias("text"),
    ).filter(F.col("path").contains(folder))


def find_failures(lines: DataFrame) -> DataFrame:
    """(path, depth, kind, place): per failed log, the line with the marker of its failure.

    Each task reduces its lines to one place per log and marker before anything is shuffled.
    """
    marks = lines.select(
        "path", "place",
        F.when(F.col("text").contains(TRACEBACK), "traceback")
        .when(F.col("text").contains(ANALYSIS), "analysis").alias("kind"),
    ).filter("kind IS NOT NULL")
    first = marks.groupBy("path").agg(
        F.min(F.when(F.col("kind") == "traceback", F.col("place"))).alias("traced"),
        F.min("place").alias("other"),
    )
    depth = F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit("")))
    return first.select(
        "path", depth.alias("depth"),
        F.when(F.col("traced").isNotNull(), "traceback").otherwise("analysis").alias("kind"),
        F.coalesce("traced", "other").alias("place"),
    )


def failure_lines(lines: DataFrame) -> DataFrame:
    """(path, kind, place, text): all lines of failed logs from the marker to the end."""
    failures = find_failures(lines).select("path", "kind", F.col("place").alias("marker"))
    return lines.join(failures, "path").filter("place >= marker").select("path", "kind", "place", "text")


def scan_failures(
    logs: DataFrame, before: int = 0, after: int | None = None, tail: int | None = None
) -> DataFrame:
    """Per log: depth of its path, kind of failure, the excerpt, and the end of the text.

    The excerpt begins at the marker of the failure and runs to the end of the log. A reader that
    shows less of it can ask for ``before`` and ``after`` characters around the marker, and for
    the last ``tail`` characters. Clean logs have a null kind and excerpt. Order the result by
    depth and path to read it the way ``first_failure`` does; the scan itself needs no shuffle.
    """
    text, traced = F.col("text"), F.col("text").contains(TRACEBACK)
    at = F.when(traced, F.locate(TRACEBACK, text)).when(
        text.contains(ANALYSIS), F.locate(ANALYSIS, text)
    )
    start = F.greatest(F.col("at") - before, F.lit(1))
    size = F.length(text) if after is None else F.col("at") + after - start
    depth = F.length("path") - F.length(F.replace(F.col("path"), F.lit("/"), F.lit("")))
    return logs.withColumns({"traced": traced, "at": at}).select(
        "path",
        depth.alias("depth"),
        F.when(F.col("traced"), "traceback").when(F.col("at") > 0, "analysis").alias("kind"),
        F.when(F.col("at") > 0, F.substring(text, start, size)).alias("excerpt"),
        (text if tail is None else F.right(text, F.lit(tail))).alias("tail"),
    )


def first_failure(logs: DataFrame) -> DataFrame:
    """The failure in the log with the shallowest path, as one row (or none)."""
    return scan_failures(logs).filter(F.col("kind").isNotNull()).orderBy("depth", "path").limit(1)
