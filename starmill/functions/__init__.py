"""Column functions shared by the marts, the checks and the chart aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text that reads as a decimal number, with optional sign, fraction and exponent.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _as_column(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def parse_ts(column: str | Column) -> Column:
    """Timestamp from text; null, not an error, where the text is malformed."""
    return F.try_to_timestamp(_as_column(column))


def number(column: str | Column) -> Column:
    """A double in which NaN and the infinities count as missing."""
    value = _as_column(column).cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def days_between(end: str, start: str) -> Column:
    """Whole calendar days from ``start`` to ``end``."""
    return F.datediff(F.to_date(end), F.to_date(start))


def month_label(year: str, month: str) -> Column:
    """``YYYY-MM``; sorts as text. Null years or months read as ``unknown``."""
    text = F.format_string("%04d-%02d", F.col(year), F.col(month))
    return F.when(F.col(year).isNotNull() & F.col(month).isNotNull(), text).otherwise("unknown")


def quarter_label(year: str, quarter: str) -> Column:
    """``YYYY-Qn``; sorts as text. Null years or quarters read as ``unknown``."""
    text = F.format_string("%04d-Q%d", F.col(year), F.col(quarter))
    return F.when(F.col(year).isNotNull() & F.col(quarter).isNotNull(), text).otherwise("unknown")


def number_or_zero(column: str) -> Column:
    """Chart value: bad, missing, NaN or infinite numbers count as zero."""
    return F.coalesce(number(F.col(column).try_cast("double")), F.lit(0.0))


def label_or_unknown(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("unknown"))


def in_period(year: str, month: str, years: list[int], months: list[int]) -> Column:
    return F.col(year).isin(list(years)) & F.col(month).isin(list(months))
