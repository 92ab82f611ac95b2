"""Months that change in one step, and the schema of each without opening a file.

A month of a table is written to a folder of its own, ``year=/month=/_version=V``, where nobody looks
for it yet. One small file, the mark ``_versions/year=/month=/V.json``, then makes V the month's
current version: creating it is the switch. A table whose rows belong to another one's, such as the
rejects of a load, has no marks of its own but a link to the other's, so that one mark switches both.
A refresh of a whole table writes all its months under one version and marks it for all of them.

A mark also holds the schema its version was written with. So the schema of a table is merged from
the marks on the driver, one per calendar month, instead of from the footers of its files.

The version before the current one stays until the next switch, for queries that are still reading
it. Months without marks, written as plain folders by others, are read as they are.
"""

from __future__ import annotations

import datetime
import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.model import RunKey
from tidemark.sources.files import Store

VERSION = "_version"
MARKS = "_versions"
_ALL = "all"
_LINK = "_marks_at"
_PREFIX = f"{VERSION}="


class SchemaConflictError(ValueError):
    """Months hold a column in different types and cannot be read as one table."""


@dataclass(frozen=True)
class Month:
    """Where the rows of a month are; ``version`` and ``mark`` are None for a plain folder."""

    path: str
    version: str | None = None
    mark: str | None = None


def new_version() -> str:
    """Later versions sort after earlier ones; no two are equal."""
    now = datetime.datetime.now(datetime.UTC)
    return f"{now:%Y%m%dT%H%M%S}{now.microsecond:06d}-{uuid.uuid4().hex[:8]}"


def version_path(root: str, key: RunKey, version: str) -> str:
    return f"{root}/{key.partition}/{_PREFIX}{version}"


def _marks(store: Store, folder: str) -> list[tuple[str, str]]:
    """(version, path) of the marks in a folder, oldest first."""
    return [(name.removesuffix(".json"), f"{folder}/{name}") for name in store.names(folder) if name.endswith(".json")]


class _Table:
    """One listing of a table's marks and folders."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root, self.store = root.rstrip("/"), Store(spark, root)
        link = f"{self.root}/{_LINK}"
        self.linked = self.store.exists(link)
        # A month is current where the rows that the mark was made for are.
        self.base = self.store.read(link) if self.linked else self.root
        self.all = _marks(self.store, f"{self.base}/{MARKS}/{_ALL}")
        # Tables that were only ever refreshed as a whole have no marks of single months.
        self.years = set(self.store.names(f"{self.base}/{MARKS}"))

    def keys(self) -> list[RunKey]:
        """Months that have a folder."""
        found = []
        for year in self.store.names(self.root):
            if match := re.fullmatch(r"year=(\d+)", year):
                for month in self.store.names(f"{self.root}/{year}"):
                    if inner := re.fullmatch(r"month=(\d+)", month):
                        found.append(RunKey(int(match[1]), int(inner[1])))
        return found

    def marks(self, key: RunKey) -> list[tuple[str, str]]:
        if key.partition.partition("/")[0] not in self.years:
            return []
        return _marks(self.store, f"{self.base}/{MARKS}/{key.partition}")

    def month(self, key: RunKey) -> Month | None:
        """The current version of a month, or its plain folder; None if there is neither."""
        folder = f"{self.root}/{key.partition}"
        marks = self.marks(key) + self.all[-1:]
        there = self.store.names(f"{self.base}/{key.partition}")
        newest_refresh = self.all[-1][0] if self.all else ""
        for version, mark in sorted(marks, reverse=True):
            if f"{_PREFIX}{version}" in there:
                path = version_path(self.root, key, version)
                return Month(path, version, mark) if not self.linked or self.store.exists(path) else None
            if version == newest_refresh:
                break  # a refresh without this month took it out
        own = self.store.names(folder) if self.linked else there
        plain = any(not name.startswith(("_", ".")) for name in own)
        return Month(folder) if plain else None


def current_month(spark: SparkSession, root: str, key: RunKey) -> Month | None:
    return _Table(spark, root).month(key)


def current_months(spark: SparkSession, root: str) -> dict[RunKey, Month]:
    """The current version of every month of a table. The driver sees calendar months."""
    table = _Table(spark, root)
    return {key: month for key in table.keys() if (month := table.month(key)) is not None}


def month_path(spark: SparkSession, root: str, key: RunKey) -> str:
    """Where the rows of a month are; a path without files if there are none."""
    month = current_month(spark, root, key)
    return month.path if month else version_path(root, key, "none")


def switch_month(spark: SparkSession, root: str, key: RunKey, version: str, schema: T.StructType) -> None:
    """Make a written version the current one, here and in the tables linked to this one."""
    _write_mark(spark, f"{root}/{MARKS}/{key.partition}", version, schema)


def switch_all(spark: SparkSession, root: str, version: str, schema: T.StructType) -> None:
    """Make a version the current one of every month; months that were not written leave the table."""
    _write_mark(spark, f"{root}/{MARKS}/{_ALL}", version, schema)


def _write_mark(spark: SparkSession, folder: str, version: str, schema: T.StructType) -> None:
    store = Store(spark, folder)
    store.make(folder)
    store.write(f"{folder}/{version}.json", json.dumps({"schema": schema.jsonValue()}))


def link_marks(spark: SparkSession, root: str, base: str) -> None:
    """Let the marks of ``base`` decide over the months of ``root``, too."""
    store, link = Store(spark, root), f"{root}/{_LINK}"
    if store.exists(link) and store.read(link) == base:
        return
    store.make(root)
    store.delete(link)
    store.write(link, base)


def _tidy(table: _Table, key: RunKey, month: Month | None) -> None:
    version = month.version if month else ""
    if month is None and table.linked:
        # A linked month without rows of its own has no folder, but the other table has its version.
        version = next((v for v, _ in reversed(table.marks(key))), "")
    folder = f"{table.root}/{key.partition}"
    names = table.store.names(folder)
    older = [n for n in names if n.startswith(_PREFIX) and n < f"{_PREFIX}{version}"]
    for name in [*older[:-1], *(n for n in names if not n.startswith(_PREFIX))]:
        table.store.delete(f"{folder}/{name}")
    if not table.linked:
        for _, mark in [m for m in table.marks(key) if m[0] < version][:-1]:
            table.store.delete(mark)


def tidy_month(spark: SparkSession, root: str, key: RunKey) -> None:
    """Delete what a switch has made obsolete: plain files, and all versions older than the one that
    was current before. Versions that are newer than the current one may still be in the making."""
    table = _Table(spark, root)
    month = table.month(key)
    if month is None or month.version is not None:
        _tidy(table, key, month)


def tidy_all(spark: SparkSession, root: str) -> None:
    """The same after a refresh of the whole table; months that left it are deleted."""
    table = _Table(spark, root)
    for key in table.keys():
        month = table.month(key)
        if month is None:
            table.store.delete(f"{root}/{key.partition}")
        else:
            _tidy(table, key, month)
    for _, mark in table.all[:-1]:
        table.store.delete(mark)


def discard_version(spark: SparkSession, root: str, key: RunKey, version: str) -> None:
    """Delete a version that did not become the current one."""
    Store(spark, root).delete(version_path(root, key, version))


def remove_month(spark: SparkSession, root: str, key: RunKey) -> None:
    """Take a month out of a table: its marks first, so that nobody finds it half deleted."""
    store = Store(spark, root)
    store.delete(f"{root}/{MARKS}/{key.partition}")
    store.delete(f"{root}/{key.partition}")


def written_schema(spark: SparkSession, months: Iterable[Month]) -> T.StructType:
    """All columns of some versions, in the order in which they appeared."""
    fields: dict[str, T.StructField] = {}
    marks = sorted({m.mark for m in months}, key=lambda mark: mark.rpartition("/")[2])
    for mark in marks:
        schema = T.StructType.fromJson(json.loads(Store(spark, mark).read(mark))["schema"])
        for field in schema.fields:
            known = fields.setdefault(field.name, T.StructField(field.name, field.dataType))
            if known.dataType != field.dataType:
                raise SchemaConflictError(
                    f"column {field.name} is {known.dataType.simpleString()} in some months and "
                    f"{field.dataType.simpleString()} in others"
                )
    return T.StructType(list(fields.values()))
