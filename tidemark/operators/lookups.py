"""Joins of the facts with the small zone lookup."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import ROLES

# A lookup is broadcast only if its measured size is at most this. Larger ones are joined with a
# shuffle, where adaptive execution splits the partitions of hot keys.
BROADCAST_BYTES = 64 * 1024 * 1024
# The entries of a larger lookup that some facts use are broadcast up to this size.
REDUCED_BYTES = 64 * 1024 * 1024


class DuplicateKeyError(ValueError):
    """The lookup lists a key twice, which would multiply the facts joined to it."""


@dataclass(frozen=True)
class Lookup:
    """A lookup whose keys were checked to be unique and whose size was measured."""

    frame: DataFrame
    key: str
    rows: int
    bytes: int
    reduced: bool = False

    def side(self, frame: DataFrame, limit: int | None = None) -> DataFrame:
        """``frame`` (derived from the lookup) as the build side of a join."""
        most = REDUCED_BYTES if self.reduced else BROADCAST_BYTES
        return F.broadcast(frame) if self.bytes <= (most if limit is None else limit) else frame


def _row_bytes(schema: T.StructType) -> Column:
    sizes = [
        F.coalesce(F.octet_length(f"`{f.name}`"), F.lit(0)) + 16
        if isinstance(f.dataType, T.StringType) else F.lit(16)
        for f in schema.fields
    ]
    return reduce(Column.__add__, sizes).cast("bigint")


def measure(frame: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a small table, in one job."""
    rows, size = frame.agg(F.count(F.lit(1)), F.sum(_row_bytes(frame.schema))).first()
    return rows, size or 0


def check_lookup(frame: DataFrame, key: str = "LocationID") -> Lookup:
    """Measure the lookup and make sure its keys are unique, in one small job."""
    per_key = frame.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(frame.schema)).alias("bytes")
    )
    repeated = F.col(key).isNotNull() & (F.col("n") > 1)
    facts = per_key.agg(
        F.sum("n").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.count_if(repeated).alias("repeated"),
        F.min(F.when(repeated, F.col(key))).alias("example"),
    ).first()
    if facts["repeated"]:
        raise DuplicateKeyError(
            f"{facts['repeated']} values of {key} occur more than once in the lookup, "
            f"for example {facts['example']}"
        )
    return Lookup(frame, key, facts["rows"] or 0, facts["bytes"] or 0)


def _known_keys(lookup: Lookup, label: str) -> DataFrame:
    return lookup.frame.where(F.col(label).isNotNull() & F.col(lookup.key).isNotNull())


def flag_known(facts: DataFrame, column: str, lookup: Lookup, flag: str,
               label: str = "Zone") -> DataFrame:
    """Add a boolean: does ``column`` have a lookup row with a non-null ``label``?"""
    key, hit = f"{flag}_key", f"{flag}_hit"
    known = _known_keys(lookup, label).select(F.col(lookup.key).alias(key), F.lit(True).alias(hit))
    return (
        facts.join(lookup.side(known), facts[column] == F.col(key), "left")
        .withColumn(flag, F.coalesce(hit, F.lit(False)))
        .drop(hit, key)
    )


def orphans(facts: DataFrame, column: str, lookup: Lookup, label: str = "Zone") -> DataFrame:
    """Facts whose ``column`` is NULL or has no lookup row with a non-null ``label``."""
    known = _known_keys(lookup, label).select(F.col(lookup.key).alias("_key"))
    return facts.join(lookup.side(known), facts[column] == F.col("_key"), "left_anti")


def matched(facts: DataFrame, column: str, lookup: Lookup, label: str = "Zone") -> DataFrame:
    """The complement of ``orphans``."""
    known = _known_keys(lookup, label).select(F.col(lookup.key).alias("_key"))
    return facts.join(lookup.side(known), facts[column] == F.col("_key"), "left_semi")


def role_of(lookup: Lookup, prefix: str, key_name: str) -> DataFrame:
    """The lookup under one role: every attribute takes the role's prefix before the join, so a
    fact column named like a lookup column stays untouched and unambiguous."""
    attributes = [c for c in lookup.frame.columns if c != lookup.key]
    return lookup.frame.select(
        F.col(lookup.key).alias(key_name), *[F.col(c).alias(prefix + c) for c in attributes]
    )


def enrich(facts: DataFrame, lookup: Lookup, roles: Mapping[str, str] = ROLES) -> DataFrame:
    """Add the lookup's attributes once per role. Facts without a match keep NULL attributes."""
    result = facts
    for column, prefix in roles.items():
        key = f"_{prefix}_key"
        side = role_of(lookup, prefix, key)
        clash = sorted(set(side.columns) & set(result.columns))
        if clash:
            raise ValueError(f"fact columns would be hidden by the {prefix} role: {clash}")
        result = result.join(lookup.side(side), result[column] == F.col(key), "left").drop(key)
    return result
