"""A lookup with history: facts are joined with the entry that was valid at their time.

An entry holds from ``valid_from`` (included) up to ``valid_to`` (excluded); null ends are open. The
interval join is an equi join: each entry is cut into the calendar months it touches, within the months
of the facts, and joined on key and month; the exact times are a residual condition. So it can be
broadcast or shuffled like any equi join, and no pair of different months is ever compared.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import ROLES, RunKey
from tidemark.operators.lookups import Lookup, measure
from tidemark.operators.names import step_aside

VALID_FROM, VALID_TO = "valid_from", "valid_to"


class OverlapError(ValueError):
    """Two entries of a key hold at the same time, or one ends before it starts."""


@dataclass(frozen=True)
class DatedLookup:
    """A lookup with validity periods that were checked not to overlap."""

    frame: DataFrame
    key: str


def check_dated(frame: DataFrame, key: str = "LocationID") -> DatedLookup:
    """Make sure that at most one entry of a key holds at any time.

    Touching periods are fine. Entries with a null key match nothing and are not compared.
    """
    start, end = F.col(VALID_FROM), F.col(VALID_TO)
    in_time = Window.partitionBy(key).orderBy(start.asc_nulls_first(), end.asc_nulls_last())
    before = F.lag(F.struct(VALID_TO)).over(in_time)
    open_before = before.isNotNull() & before[VALID_TO].isNull()
    overlaps = before.isNotNull() & (open_before | start.isNull() | (before[VALID_TO] > start))
    wrong = frame.where(F.col(key).isNotNull()).withColumn("_overlaps", overlaps | (start >= end))
    found = wrong.where("_overlaps").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("example")).first()
    if found["n"]:
        raise OverlapError(f"{found['n']} periods overlap or are empty, for example of {key} {found['example']}")
    return DatedLookup(frame, key)


def month_number(time: Column) -> Column:
    return F.year(time) * 12 + F.month(time)


def month_slices(lookup: DatedLookup, first: RunKey, last: RunKey) -> DataFrame:
    """One row per entry and calendar month it touches between two months, as ``_month``."""
    low, high = (F.lit(k.year * 12 + k.month) for k in (first, last))
    start = F.greatest(F.coalesce(month_number(F.col(VALID_FROM)), low), low)
    end = F.least(F.coalesce(month_number(F.col(VALID_TO)), high), high)
    sliced = lookup.frame.where(F.col(lookup.key).isNotNull()).withColumns({"_first": start, "_last": end})
    months = F.explode(F.sequence("_first", "_last"))
    return sliced.where("_first <= _last").withColumn("_month", months).drop("_first", "_last")


def months_of(facts: DataFrame, time: str) -> tuple[RunKey, RunKey] | None:
    """The first and last calendar month of the facts; None if no row has a time."""
    low, high = facts.agg(F.min(time), F.max(time)).first()
    return (RunKey(low.year, low.month), RunKey(high.year, high.month)) if low else None


def enrich_as_of(
    facts: DataFrame,
    lookup: DatedLookup,
    time: str,
    roles: Mapping[str, str] = ROLES,
    months: tuple[RunKey, RunKey] | None = None,
) -> DataFrame:
    """Add the attributes of the entry that was valid at ``time``, once per role.

    Facts without a valid entry, or without a time, keep NULL attributes; no fact is multiplied.
    ``months`` are the first and last month of the facts; where they are not given, they are looked up
    in one narrow job. The slices are broadcast if their measured size allows it.
    """
    months = months or months_of(facts, time) or (RunKey(1, 1), RunKey(1, 1))
    slices = month_slices(lookup, *months)
    measured = Lookup(slices, lookup.key, *measure(slices))
    attributes = [c for c in lookup.frame.columns if c not in (lookup.key, VALID_FROM, VALID_TO)]
    result, names = step_aside(facts)
    for column, prefix in roles.items():
        clash = sorted({prefix + a for a in attributes} & set(result.columns))
        if clash:
            raise ValueError(f"fact columns would be hidden by the {prefix} role: {clash}")
        side = slices.select(
            F.col(lookup.key).alias("_key"),
            F.col("_month").alias("_slice"),
            F.col(VALID_FROM).alias("_from"),
            F.col(VALID_TO).alias("_to"),
            *[F.col(a).alias(prefix + a) for a in attributes],
        )
        at = result[time]
        valid = (
            (result[column] == F.col("_key"))
            & (month_number(at) == F.col("_slice"))
            & (F.col("_from").isNull() | (at >= F.col("_from")))
            & (F.col("_to").isNull() | (at < F.col("_to")))
        )
        result = result.join(measured.side(side), valid, "left").drop("_key", "_slice", "_from", "_to")
    return names.back(result)
