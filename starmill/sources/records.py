"""CSV files whose quoted fields hold line breaks, read by many tasks.

Spark's ``multiLine`` reads such a file in one task, since only its start tells which line breaks are
quoted. Here byte ranges are read as lines by any number of tasks, and cut into pieces of at most ``PIECE``
lines, so what a task sorts does not grow with the files. A line break is quoted if an odd
number of quotes comes before it; every piece counts its own, and a scan over the pieces (one row each)
tells how many come before it. From there on all record boundaries are known. Most records are one
line; only the lines of others are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starmill.session import stored

PIECE = 1 << 12  # no more than a window keeps without a sorter of its own
RANGE = ("file", "block", "piece")
# At least so many shuffled parts for each part that is read (by default of 128 MB).
SPLITS = 4
# Options that belong to the reading of files, not of single records.
FILE_OPTIONS = ("header", "multiLine", "inferSchema", "lineSep")


def _even(column: Column) -> Column:
    return column % 2 == 0


def _lines(spark: SparkSession, path: str, quote: str) -> DataFrame:
    """Every line with its quotes, those before it in its piece, and where a record last began.

    ``even`` is that place if the piece itself starts outside of quotes, ``odd`` if it starts inside.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), SPLITS * text.rdd.getNumPartitions())
    read = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    ).withColumn("piece", F.expr(f"line div {PIECE}")).repartition(parts, *RANGE)
    value = F.col("value")
    quotes = F.length(value) - F.length(F.replace(value, F.lit(quote), F.lit("")))
    so_far = Window.partitionBy(*RANGE).orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    counted = read.withColumn("quotes", quotes.cast("long")).withColumns({
        "before": F.sum("quotes").over(so_far) - F.col("quotes"),
        # The first line of a file that is not blank starts with one.
        "filled": F.count_if(~value.isin("", "\r")).over(so_far),
    })
    return stored(
        counted.withColumns({
            "even": F.max(F.when(_even(F.col("before")), F.col("line"))).over(so_far),
            "odd": F.max(F.when(~_even(F.col("before")), F.col("line"))).over(so_far),
        }),
        "csv-lines",
    )


def _ranges(lines: DataFrame) -> DataFrame:
    """Per piece the quotes and filled lines before it, and the place where the last record before it began.

    ``crlf`` is true in files whose first line ends with a carriage return.
    """
    filled = ~F.col("value").isin("", "\r")
    ranges = lines.groupBy(*RANGE).agg(
        F.sum("quotes").alias("held"), F.max("even").alias("even"), F.max("odd").alias("odd"),
        F.max("filled").alias("full"),
        F.max((F.col("filled") == 1) & filled & F.col("value").endswith("\r")).alias("crlf"),
    )
    earlier = Window.partitionBy("file").orderBy("block", "piece").rowsBetween(Window.unboundedPreceding, -1)
    known = ranges.withColumns({
        "outside": F.coalesce(F.sum("held").over(earlier), F.lit(0)),
        "begun": F.coalesce(F.sum("full").over(earlier), F.lit(0)),
    })
    began = F.when(_even(F.col("outside")), F.col("even")).otherwise(F.col("odd"))
    last = F.when(began.isNotNull(), F.struct("block", began.alias("line")))
    return known.select(
        *RANGE, "held", "outside", "begun", F.last(last, True).over(earlier).alias("open"),
        F.max(F.col("crlf") & (F.col("begun") == 0)).over(Window.partitionBy("file")).alias("crlf"),
    )


def read_records(spark: SparkSession, path: str, quote: str = '"') -> DataFrame | None:
    """``file, first, record``: the records of the CSV files at ``path``, in no order.

    ``first`` is true of a file's first record. Where a file's first line ends with a carriage return
    and a line feed, those two are its line breaks, and count as one line feed inside of fields. Quotes must be doubled inside of quoted fields and may not stand in others; where a
    file's quotes do not pair up, nothing is returned.
    """
    lines = _lines(spark, path, quote)
    ranges = stored(_ranges(lines), "csv-ranges")
    odd = ranges.groupBy("file").agg(F.sum("held").alias("held")).filter("held % 2 = 1")
    if not odd.isEmpty():
        return None
    before = F.col("before") + F.col("outside")
    placed = lines.join(ranges.drop("held"), list(RANGE)).withColumns({
        "starts": _even(before),
        "ends": _even(before + F.col("quotes")),
        "own": F.when(_even(F.col("outside")), F.col("even")).otherwise(F.col("odd")),
    })
    first = (F.col("begun") == 0) & (F.col("filled") == 1) & F.col("starts")
    broken = F.regexp_replace(F.regexp_replace("value", "\r\n", "\n"), "\r$", "")
    record = F.when(F.col("crlf"), broken).otherwise(F.col("value")).alias("record")
    short = placed.filter("starts AND ends").select("file", first.alias("first"), record)
    place = F.when(F.col("own").isNotNull(), F.struct("block", F.col("own").alias("line")))
    long = (
        placed.filter("NOT (starts AND ends)")
        .groupBy("file", F.coalesce(place, F.col("open")).alias("place"))
        .agg(
            F.max(first).alias("first"), F.max("crlf").alias("crlf"),
            F.array_sort(F.collect_list(F.struct("block", "line", "value"))).alias("parts"),
        )
        .select("file", "first", "crlf", F.array_join("parts.value", "\n").alias("value"))
        .select("file", "first", record)
    )
    return short.unionByName(long).filter("record <> ''")


def read_csv(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """As ``spark.read.options(header, multiLine).csv`` with text columns, but split into tasks.

    Files whose quotes are escaped otherwise, or do not pair up, are read by that reader.
    """
    whole = spark.read.options(**{**options, "header": "true", "multiLine": "true"}).csv(path)
    quote = options.get("quote", '"')
    records = read_records(spark, path, quote) if options.get("escape") == quote else None
    if records is None:
        return whole
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in whole.columns)
    kept = {k: v for k, v in options.items() if k not in FILE_OPTIONS}
    return (
        records.filter("NOT first")
        .select(F.from_csv("record", F.lit(schema), kept).alias("of"))
        .select("of.*")
    )
