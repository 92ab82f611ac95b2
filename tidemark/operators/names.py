"""Data columns of any name beside the columns the library adds while it works.

Added columns start with an underscore, or are those that directories name. Data columns of such
names, and those whose names would need quoting, step aside under free ones first and take their names
back before anything is written.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tidemark.model import MONTH_KEYS

_PLAIN = re.compile(r"[A-Za-z]\w*")
# Columns that come from directory names when a table is read; a file's column would be hidden.
DIRECTORY_NAMES = frozenset({*MONTH_KEYS, "layer", "rule", "destination"})


def free_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, or the first of its numbered forms that is not in ``taken``, whatever the case."""
    low = {name.lower() for name in taken}
    name, n = wanted, 1
    while name.lower() in low:
        n += 1
        name = f"{wanted}{n}"
    return name


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """``withColumnsRenamed`` that does nothing for columns that are not there."""
    present = {old: new for old, new in names.items() if old in df.columns}
    return df.withColumnsRenamed(present) if present else df


@dataclass(frozen=True)
class Aside:
    """Data columns that stepped aside: original name -> free name."""

    names: dict[str, str]

    def back(self, df: DataFrame) -> DataFrame:
        return renamed(df, {new: old for old, new in self.names.items()})

    def name(self, column: str) -> str:
        return self.names.get(column, column)


def step_aside(df: DataFrame, also: Iterable[str] = ()) -> tuple[DataFrame, Aside]:
    """``df`` with plain names only (a letter first, none in ``also``), and the way back."""
    others = {name.lower() for name in also}
    taken, names = list(df.columns), {}
    for column in df.columns:
        if not _PLAIN.fullmatch(column) or column.lower() in others:
            names[column] = free_name("aside", taken)
            taken.append(names[column])
    return renamed(df, names), Aside(names)


def aside(operation: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let an operation on frames of one schema take data columns of any name."""

    @functools.wraps(operation)
    def run(first: DataFrame, *others, **named) -> DataFrame:
        moved, names = step_aside(first)
        others = [o.toDF(*moved.columns) if isinstance(o, DataFrame) else o for o in others]
        return names.back(operation(moved, *others, **named))

    return run


def keep_clear_of_directories(df: DataFrame, also: Iterable[str] = ()) -> DataFrame:
    """Columns that a directory name (or one of ``also``) would hide, such as ``year``, under
    ``landed_year`` instead."""
    names: dict[str, str] = {}
    hidden = {*DIRECTORY_NAMES, "_version", *also}
    for column in df.columns:
        if column.lower() in hidden:
            names[column] = free_name(f"landed_{column.lstrip('_')}", [*df.columns, *names.values()])
    return renamed(df, names)
