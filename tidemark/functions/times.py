"""Time expressions. Event times are TIMESTAMP_NTZ, so none of these depend on the session zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import RunKey


def floor_second(ts: Column) -> Column:
    """``ts`` without its fraction of a second.

    ``date_trunc`` would turn TIMESTAMP_NTZ into a zoned TIMESTAMP and so move times that fall in
    a daylight-saving gap of the session zone; subtracting the fraction keeps the type.
    """
    return ts - F.make_dt_interval(secs=F.extract(F.lit("SECOND"), ts) % 1)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole seconds from ``start`` to ``end``, each floored to its second first (BIGINT)."""
    return (floor_second(end) - floor_second(start)).cast("bigint")


def in_month(ts: Column, key: RunKey, dtype: T.DataType | None = None) -> Column:
    """Half-open range test: a plain comparison with literals, which reaches the Parquet scan.

    ``dtype`` is the type of ``ts``; literals of the same type keep the column free of casts.
    """
    dtype = dtype or T.TimestampNTZType()
    after = key.next()
    first = F.lit(f"{key.year:04d}-{key.month:02d}-01 00:00:00").cast(dtype)
    beyond = F.lit(f"{after.year:04d}-{after.month:02d}-01 00:00:00").cast(dtype)
    return (ts >= first) & (ts < beyond)


def year_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy")


def month_text(ts: Column) -> Column:
    return F.date_format(ts, "MM")
