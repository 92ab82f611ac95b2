"""Aggregate tables over the trips.

All of them roll up from one small cube per location id, pickup hour and calendar month. The facts
are therefore scanned once (four columns), never joined, and pre-aggregated before the only
shuffle; zone and borough names are joined to the cube afterwards. Names may repeat over ids, so
every mart groups again by name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.model import (
    OUT_BOROUGH,
    OUT_FARE,
    OUT_HOUR,
    OUT_HOUR_TRIPS,
    OUT_MONTH,
    OUT_MONTH_TRIPS,
    OUT_RANK,
    OUT_ZONE,
    OUT_ZONE_TRIPS,
    PICKUP_LOCATION,
    PICKUP_TIME,
)
from tidemark.operators.lookups import Lookup, enrich

PEAK_HOURS = 3


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def cube_keys() -> list[Column]:
    return [
        F.col(PICKUP_LOCATION),
        F.hour(PICKUP_TIME).alias(OUT_HOUR),
        F.month(PICKUP_TIME).alias(OUT_MONTH),
    ]


def trip_cube(facts: DataFrame, by: Sequence[Column | str] | None = None) -> DataFrame:
    """Trips, sum of the fare-per-mile ratios and number of such ratios, per id, hour and month.

    A mean cannot be re-aggregated, so it is carried as its sum and its non-null count.
    """
    per_mile = ratio(F.col("fare_amount"), F.col("trip_distance"))
    return facts.groupBy(*(by or cube_keys())).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(per_mile).alias("ratio_sum"),
        F.count(per_mile).alias("ratio_count"),
    )


def name_cube(cube: DataFrame, lookup: Lookup) -> DataFrame:
    """The cube with the pickup borough and zone of each location id (NULL if unmatched)."""
    return enrich(cube, lookup, {PICKUP_LOCATION: "PU"})


# The groupings of the four sums, and what marks each in ``rollups``: one bit per column left out.
_KEYS = (OUT_BOROUGH, OUT_ZONE, OUT_HOUR, OUT_MONTH)
BY_BOROUGH, BY_ZONE, BY_ZONE_HOUR, BY_MONTH = (OUT_BOROUGH,), (OUT_ZONE,), (OUT_ZONE, OUT_HOUR), (OUT_MONTH,)


def grouping_number(by: tuple[str, ...]) -> int:
    return sum(1 << i for i, key in enumerate(reversed(_KEYS)) if key not in by)


def rollups(named_cube: DataFrame) -> DataFrame:
    """The sums of the cube by borough, by zone, by zone and hour, and by month, in one aggregation.

    ``grouping`` tells the groupings apart; a key that is NULL in the data is still a group.
    """
    sets = [[F.col(c) for c in by] for by in (BY_BOROUGH, BY_ZONE, BY_ZONE_HOUR, BY_MONTH)]
    return named_cube.groupingSets(sets, *[F.col(k) for k in _KEYS]).agg(
        F.grouping_id().alias("grouping"),
        F.sum("trips").alias("trips"),
        F.sum("ratio_sum").alias("ratio_sum"),
        F.sum("ratio_count").alias("ratio_count"),
    )


def rollup(summed: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """One grouping of ``rollups``: its keys and sums."""
    rows = summed.where(F.col("grouping") == grouping_number(by))
    return rows.select(*by, "trips", "ratio_sum", "ratio_count")


def avg_fare_per_mile(cube: DataFrame) -> DataFrame:
    """Mean of the per-trip ratios (not the ratio of the sums) per pickup borough."""
    return cube.groupBy(OUT_BOROUGH).agg(
        ratio(F.sum("ratio_sum"), F.sum("ratio_count")).alias(OUT_FARE)
    )


def trips_per_zone(cube: DataFrame) -> DataFrame:
    return cube.groupBy(OUT_ZONE).agg(F.sum("trips").alias(OUT_ZONE_TRIPS))


def trips_per_zone_hour(cube: DataFrame) -> DataFrame:
    return cube.groupBy(OUT_ZONE, OUT_HOUR).agg(F.sum("trips").alias(OUT_HOUR_TRIPS))


def trips_per_month(cube: DataFrame) -> DataFrame:
    """Trips per calendar month 1..12, all years together."""
    return cube.groupBy(OUT_MONTH).agg(F.sum("trips").alias(OUT_MONTH_TRIPS))


def top_per_group(df: DataFrame, group: str, measure: str, tie_break: str, k: int) -> DataFrame:
    """The ``k`` rows of each group with the largest measure, numbered from 1 in ``row_num``.

    The tie-break makes the choice unique. Spark cuts each group to ``k`` rows before and after
    the shuffle, so the size of a group does not matter.
    """
    order = Window.partitionBy(group).orderBy(F.col(measure).desc(), F.col(tie_break).asc())
    return df.withColumn(OUT_RANK, F.row_number().over(order)).where(F.col(OUT_RANK) <= k)


def peak_hours(zone_hours: DataFrame, k: int = PEAK_HOURS) -> DataFrame:
    """The busiest hours of each zone; equal counts go to the earlier hour."""
    return top_per_group(zone_hours, OUT_ZONE, OUT_HOUR_TRIPS, OUT_HOUR, k)
