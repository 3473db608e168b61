"""Date and timestamp decoding of published source strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sentinel(c: Column) -> Column:
    """Publisher placeholders: a year of 9990 or later, or 1900 or earlier."""
    y = F.substring(c, 1, 4)
    return (y >= F.lit("9990")) | (y <= F.lit("1900"))


def parse_source_date(c: str | Column) -> Column:
    """Sentinel years -> null, else the tolerant date of the first 10 chars."""
    col = _c(c)
    return F.when(_sentinel(col), F.lit(None).cast("date")).otherwise(F.substring(col, 1, 10).try_cast("date"))


def parse_source_timestamp(c: str | Column) -> Column:
    """Sentinel years -> null, else the tolerant timestamp (ISO, 'Z' = UTC)."""
    col = _c(c)
    return F.when(_sentinel(col), F.lit(None).cast("timestamp")).otherwise(F.try_to_timestamp(col))


def compact_date(c: str | Column) -> Column:
    """'YYYYMMDD' -> date, null on blank or garbage."""
    return F.try_to_date(_c(c), "yyyyMMdd")


def min_date(a: str | Column, b: str | Column, open_end: str = "9999-12-31") -> Column:
    """Element-wise earliest of two optional dates; open end when both null."""
    end = F.to_date(F.lit(open_end))
    return F.least(F.coalesce(_c(a), end), F.coalesce(_c(b), end))


def is_live(day: str | Column, first: str | Column, last: str | Column) -> Column:
    """first <= day <= last, with a null bound open."""
    d = _c(day)
    return (F.coalesce(_c(first) <= d, F.lit(True))) & (F.coalesce(d <= _c(last), F.lit(True)))
