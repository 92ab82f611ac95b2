"""One month through all layers, and the tables published afterwards."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import SparkSession

from tidemark.model import GOLD_FULL, LOCATION_RANGE, Layout, RunKey
from tidemark.plans.gold import build_gold
from tidemark.plans.raw import load_raw
from tidemark.plans.report import LoadReport
from tidemark.plans.silver import load_silver
from tidemark.sinks.tables import publish_month, register_table


@dataclass(frozen=True)
class MonthReport:
    raw: LoadReport
    silver: LoadReport
    gold: tuple[str, ...]
    published: tuple[str, ...]


def _published(
    spark: SparkSession, database: str, tables: dict[str, str], key: RunKey | None = None
) -> list[str]:
    """Register tables by name and path; with ``key``, make that month visible in them. A table that
    has no file yet, because every row was rejected so far, is left out."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    published = []
    for name, path in tables.items():
        table = f"{database}.{name}"
        try:
            if key is not None:
                publish_month(spark, table, path, key)
            else:
                register_table(spark, table, path)
        except FileNotFoundError:
            continue
        published.append(table)
    return published


def publish_raw(spark: SparkSession, layout: Layout, database: str, key: RunKey) -> list[str]:
    return _published(spark, database, {"raw_facts": layout.raw_facts}, key)


def publish_silver(spark: SparkSession, layout: Layout, database: str, key: RunKey) -> list[str]:
    return _published(spark, database, {"silver_facts": layout.silver_facts}, key)


def publish_gold(
    spark: SparkSession, layout: Layout, database: str, keys: Iterable[RunKey], gold: Iterable[str]
) -> list[str]:
    """The months of the denormalised facts and the refreshed aggregates."""
    full = {f"gold_{GOLD_FULL}": layout.gold_table(GOLD_FULL)}
    published = {t for key in keys for t in _published(spark, database, full, key)}
    marts = {f"gold_{name}": layout.gold_table(name) for name in gold if name != GOLD_FULL}
    return sorted(published) + _published(spark, database, marts)


def load_month(
    spark: SparkSession,
    layout: Layout,
    key: RunKey,
    database: str | None = None,
    location_range: tuple[int, int] = LOCATION_RANGE,
) -> MonthReport:
    """Landing to silver for one month; each layer is published before the next one starts."""
    raw = load_raw(spark, layout, key, location_range)
    published = publish_raw(spark, layout, database, key) if database else []
    silver = load_silver(spark, layout, key)
    if database:
        published += publish_silver(spark, layout, database, key)
    return MonthReport(raw, silver, (), tuple(published))


def finish_months(
    spark: SparkSession, layout: Layout, keys: Iterable[RunKey], database: str | None = None
) -> tuple[list[str], list[str]]:
    """Gold once for all months loaded; the names of its tables, and of those published."""
    gold = build_gold(spark, layout)
    return gold, publish_gold(spark, layout, database, keys, gold) if database else []


def run_month(
    spark: SparkSession,
    layout: Layout,
    key: RunKey,
    database: str | None = None,
    location_range: tuple[int, int] = LOCATION_RANGE,
) -> MonthReport:
    """Landing to gold for one month; the first failure ends the run. Safe to repeat.

    Each layer is published when it is written, so a later failure does not hide it.
    """
    loaded = load_month(spark, layout, key, database, location_range)
    gold, published = finish_months(spark, layout, [key], database)
    return replace(loaded, gold=tuple(gold), published=loaded.published + tuple(published))
