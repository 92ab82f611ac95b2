"""Expressions over file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.model import MONTH_KEY_PATTERN


def last_path_part(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def month_of_path(path: Column) -> tuple[Column, Column]:
    """(year, month) as integers from the first ``YYYY-MM`` in ``path``.

    Both are NULL when the path holds none, or when its month is not 1..12.
    """
    year = F.regexp_extract(path, MONTH_KEY_PATTERN, 1).try_cast("int")
    month = F.regexp_extract(path, MONTH_KEY_PATTERN, 2).try_cast("int")
    valid = month.between(1, 12) & (year >= 1)
    return F.when(valid, year), F.when(valid, month)
