"""The zone lookup: a CSV directory with a header."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import LOOKUP_COLUMNS
from tidemark.operators import lookups
from tidemark.operators.lookups import Lookup, check_lookup, measure
from tidemark.sources.facts import _read
from tidemark.sources.scratch import scratch_path, settle


def read_lookup_frame(spark: SparkSession, path: str) -> DataFrame:
    """The lookup with its declared types; no inference pass. The header must match the names."""
    reader = spark.read.schema(LOOKUP_COLUMNS).option("header", True).option("enforceSchema", False)
    return _read(reader.csv, path, "the zone lookup")


def read_lookup(spark: SparkSession, path: str) -> Lookup:
    """The lookup, checked for unique keys and measured for broadcasting."""
    return check_lookup(read_lookup_frame(spark, path))


def reduce_lookup(lookup: Lookup, facts: DataFrame, columns: Iterable[str]) -> Lookup:
    """The entries that ``facts`` use in ``columns``, if the lookup is too large to be broadcast.

    Only the distinct keys of the facts are shuffled, after a map-side aggregate, never the facts: they
    are joined with what was found, which is broadcast if its measured size allows it.
    """
    if lookup.bytes <= lookups.BROADCAST_BYTES:
        return lookup
    keys = F.explode(F.array(*[F.col(c) for c in columns])).alias("_used")
    used = facts.select(keys).where("_used IS NOT NULL").distinct()
    found = lookup.frame.join(used, F.col(lookup.key) == F.col("_used"), "left_semi")
    found = settle(found, scratch_path(facts.sparkSession))
    return Lookup(found, lookup.key, *measure(found), reduced=True)
