"""Silver to gold: the denormalised facts and five aggregate tables.

The result is always that of a refresh over every silver month. The facts and the cube behind the
aggregates are kept per month, though, so that only months whose silver files or lookup are newer
than their cube are computed again; the aggregates themselves are rolled up from the whole cube.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.model import (
    GOLD_CUBE,
    GOLD_FARE,
    GOLD_FULL,
    GOLD_MONTH,
    GOLD_PEAK,
    GOLD_ZONE,
    GOLD_ZONE_HOUR,
    MONTH_KEYS,
    OUT_BOROUGH,
    OUT_FARE,
    OUT_HOUR,
    OUT_HOUR_TRIPS,
    OUT_MONTH,
    OUT_MONTH_TRIPS,
    OUT_ZONE,
    OUT_ZONE_TRIPS,
    PICKUP_LOCATION,
    ROLES,
    Layout,
    RunKey,
)
from tidemark.operators import marts
from tidemark.operators.lookups import Lookup, enrich
from tidemark.operators.names import step_aside
from tidemark.sinks.tables import replace_all_months, replace_month, replace_table
from tidemark.sources.facts import read_partition, read_table
from tidemark.sources.listing import list_files, list_months
from tidemark.sources.lookup import read_lookup, reduce_lookup
from tidemark.sources.scratch import remove_scratch, scratch_path, settle
from tidemark.sources.versions import remove_month

LAYER = "gold"
_CUBE = T.StructType(
    [
        T.StructField(PICKUP_LOCATION, T.IntegerType()),
        T.StructField(OUT_HOUR, T.IntegerType()),
        T.StructField(OUT_MONTH, T.IntegerType()),
        T.StructField("trips", T.LongType()),
        T.StructField("ratio_sum", T.DoubleType()),
        T.StructField("ratio_count", T.LongType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
    ]
)


def mart_frames(summed: DataFrame) -> dict[str, DataFrame]:
    """The five aggregate tables, each a part of the settled ``marts.rollups``."""
    zone_hours = marts.rollup(summed, marts.BY_ZONE_HOUR).select(
        OUT_ZONE, OUT_HOUR, F.col("trips").alias(OUT_HOUR_TRIPS)
    )
    fares = marts.ratio(F.col("ratio_sum"), F.col("ratio_count")).alias(OUT_FARE)
    return {
        GOLD_FARE: marts.rollup(summed, marts.BY_BOROUGH).select(OUT_BOROUGH, fares),
        GOLD_ZONE: marts.rollup(summed, marts.BY_ZONE).select(OUT_ZONE, F.col("trips").alias(OUT_ZONE_TRIPS)),
        GOLD_ZONE_HOUR: zone_hours,
        GOLD_MONTH: marts.rollup(summed, marts.BY_MONTH).select(OUT_MONTH, F.col("trips").alias(OUT_MONTH_TRIPS)),
        GOLD_PEAK: marts.peak_hours(zone_hours),
    }


def refresh_everything(spark: SparkSession, layout: Layout, lookup: Lookup) -> None:
    """Facts and cube of every month: two scans of silver, one of them of four columns.

    The cube is written last. A month counts as done once its cube exists.
    """
    facts, names = step_aside(read_table(spark, layout.silver_facts))
    used = reduce_lookup(lookup, facts, ROLES)
    replace_all_months(names.back(enrich(facts, used)), layout.gold_table(GOLD_FULL))
    cube = marts.trip_cube(facts, [*MONTH_KEYS, *marts.cube_keys()])
    by_month = cube.hint("rebalance", *[F.col(k) for k in MONTH_KEYS])
    replace_all_months(by_month, layout.gold_table(GOLD_CUBE))


def refresh_month(spark: SparkSession, layout: Layout, key: RunKey, lookup: Lookup) -> None:
    facts, names = step_aside(read_partition(spark, layout.silver_facts, key))
    used = reduce_lookup(lookup, facts, ROLES)
    replace_month(names.back(enrich(facts, used)), layout.gold_table(GOLD_FULL), key)
    cube = marts.trip_cube(facts).hint("rebalance")
    replace_month(cube, layout.gold_table(GOLD_CUBE), key)


def changed_months(
    spark: SparkSession, layout: Layout
) -> tuple[list[RunKey], list[RunKey]] | None:
    """Months whose silver files are not older than their cube, and months that silver no longer
    has; None if all must be refreshed, because the lookup is not older than a cube either.

    Compares file times only, one listing per table; the driver sees calendar months.
    """
    def times(path: str, when) -> DataFrame:
        return list_months(spark, path).groupBy(*MONTH_KEYS).agg(when("modified").alias("at"))

    try:
        built = times(layout.gold_table(GOLD_CUBE), F.min).withColumnRenamed("at", "built")
    except FileNotFoundError:
        return None
    silver = times(layout.silver_facts, F.max)
    months = silver.join(built, list(MONTH_KEYS), "full").orderBy(*MONTH_KEYS).collect()
    looked_up = list_files(spark, layout.lookup).agg(F.max("modified")).first()[0]
    if any(m["built"] and m["built"] <= looked_up for m in months):
        return None

    def keys(wanted) -> list[RunKey]:
        return [RunKey(m["year"], m["month"]) for m in months if wanted(m)]

    stale = keys(lambda m: m["at"] and (not m["built"] or m["built"] <= m["at"]))
    return stale, keys(lambda m: not m["at"])


def build_gold(spark: SparkSession, layout: Layout, everything: bool = False) -> list[str]:
    """Bring all gold tables up to date with silver and the lookup; returns their names."""
    lookup = read_lookup(spark, layout.lookup)
    changed = None if everything else changed_months(spark, layout)
    if changed is None:
        refresh_everything(spark, layout, lookup)
    else:
        stale, removed = changed
        for key in removed:
            remove_month(spark, layout.gold_table(GOLD_CUBE), key)
            remove_month(spark, layout.gold_table(GOLD_FULL), key)
        for key in stale:
            refresh_month(spark, layout, key, lookup)
    cube = read_table(spark, layout.gold_table(GOLD_CUBE), _CUBE)
    stage = scratch_path(spark)
    try:
        # As many rows as there are zones and hours at most: the cube is read and shuffled once.
        summed = settle(marts.rollups(marts.name_cube(cube, lookup)), stage)
        frames = mart_frames(summed)
        for name, frame in frames.items():
            replace_table(frame.hint("rebalance"), layout.gold_table(name))
    finally:
        remove_scratch(spark, stage)
    return [GOLD_FULL, *frames]
