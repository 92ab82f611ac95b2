"""The layer-to-layer loads, run end to end over all trips and read back from their tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.model import (
    GOLD_FARE,
    GOLD_FULL,
    GOLD_MONTH,
    GOLD_PEAK,
    GOLD_ZONE,
    GOLD_ZONE_HOUR,
    MONTH_KEYS,
    PICKUP_TIME,
    SILVER_CONTRACT,
    Layout,
    RunKey,
    struct_of,
)
from tidemark.plans import raw as raw_plan
from tidemark.plans import silver as silver_plan
from tidemark.plans.gold import build_gold, refresh_everything
from tidemark.plans.monthly import run_month
from tidemark.queries.registry import query
from tidemark.queries.rows import SILVER_SQL, trip_id
from tidemark.queries.views import (
    LINE_COLUMNS,
    MONTH,
    landed_trips,
    order_lines,
    select_trips,
    sql_trips,
    sql_zones,
    trips,
    zone_frame,
)
from tidemark.sinks.tables import (
    publish_month,
    read_quarantine,
    register_table,
    replace_all_months,
    replace_month,
)
from tidemark.sources.facts import SOURCE_FILE, read_partition, read_table
from tidemark.sources.files import Store
from tidemark.sources.lookup import read_lookup
from tidemark.sources.scratch import remove_scratch, scratch_path, settle
from tidemark.sources.versions import remove_month

# The test nations are 0..24; this range leaves some of them out.
RANGE = (1, 24)
_KEYS = struct_of(SILVER_CONTRACT).add("trip_key", "long")


def fresh_layout(spark: SparkSession) -> Layout:
    return Layout(scratch_path(spark))


def write_zones(spark: SparkSession, sf_dir: str, layout: Layout, partial: bool) -> None:
    zone_frame(spark, sf_dir, partial).write.option("header", True).csv(layout.lookup)


def land(spark: SparkSession, sf_dir: str, layout: Layout) -> None:
    landed_trips(spark, sf_dir).write.parquet(layout.landing_file(MONTH))


def write_raw(spark: SparkSession, sf_dir: str, layout: Layout) -> None:
    facts = trips(spark, sf_dir, "l_tax").withColumn(SOURCE_FILE, F.lit("trips"))
    raw_plan.with_audit(facts).write.parquet(f"{layout.raw_facts}/{MONTH.partition}")


def write_silver(spark: SparkSession, sf_dir: str, layout: Layout) -> None:
    """Trips by month. The lines are moved to their months before they become the wider trips."""
    year, month = MONTH_KEYS

    def dated(rows: DataFrame, time: str) -> DataFrame:
        return rows.withColumns({year: F.year(time), month: F.month(time)})

    lines = order_lines(spark, sf_dir, pickup=True, dropoff=True).select(*LINE_COLUMNS)
    moved = dated(lines, "o_orderdate").hint("rebalance", F.col(year), F.col(month))
    facts = raw_plan.with_audit(select_trips(moved).withColumn(SOURCE_FILE, F.lit("trips")))
    replace_all_months(dated(facts, PICKUP_TIME), layout.silver_facts)


def destinations(kept: DataFrame, name: str, layout: Layout) -> DataFrame:
    """Kept rows and rejects of one layer under the name of the place they went to."""
    rejects = read_quarantine(kept.sparkSession, layout.quarantine, name, _KEYS)
    row = (*trip_id(), F.col("fare_amount").alias("fare"))
    return kept.select(F.lit(name).alias("destination"), *row).unionAll(
        rejects.select(F.col("rule").alias("destination"), *row)
    )


# Only first lines of orders are landed twice, so a row's second copy is known without comparing rows.
RAW_SQL = f"""
landed AS (
  SELECT trip_key, line, pickup, dropoff, passengers, distance, nullif(flag, 'A') AS flag,
         pu, dof, fare, copy
  FROM trips JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c ON copy = 1 OR line = 1),
sorted AS (
  SELECT *, CASE WHEN copy > 1 THEN 'dropped_duplicates'
    WHEN flag IS NULL THEN 'dropped_nulls'
    WHEN pu NOT BETWEEN {RANGE[0]} AND {RANGE[1]} OR dof NOT BETWEEN {RANGE[0]} AND {RANGE[1]}
      THEN 'dropped_locations'
    WHEN pickup < TIMESTAMP '1996-03-01' OR pickup >= TIMESTAMP '1996-04-01'
      THEN 'dropped_stray_timestamps'
    ELSE 'raw' END AS destination
  FROM landed)"""


@query("raw_month",
       f"WITH {sql_trips('l_tax')}, {RAW_SQL} SELECT destination, trip_key, line, fare FROM sorted")
def raw_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = fresh_layout(spark)
    land(spark, sf_dir, layout)
    raw_plan.load_raw(spark, layout, MONTH, RANGE)
    return destinations(read_partition(spark, layout.raw_facts, MONTH), raw_plan.LAYER, layout)


@query("step_counts", f"""
WITH {sql_trips('l_tax')}, {RAW_SQL}
SELECT 'dropped_duplicates' AS step, count(*) AS rows_left FROM sorted
  WHERE destination <> 'dropped_duplicates'
UNION ALL SELECT 'dropped_nulls', count(*) FROM sorted
  WHERE destination NOT IN ('dropped_duplicates', 'dropped_nulls')
UNION ALL SELECT 'dropped_locations', count(*) FROM sorted
  WHERE destination IN ('dropped_stray_timestamps', 'raw')
UNION ALL SELECT 'dropped_stray_timestamps', count(*) FROM sorted WHERE destination = 'raw'
UNION ALL SELECT 'input', count(*) FROM sorted""")
def step_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows left after each step of the raw load."""
    layout = fresh_layout(spark)
    land(spark, sf_dir, layout)
    report = raw_plan.load_raw(spark, layout, MONTH, RANGE)
    return spark.createDataFrame(report.steps(), "step string, rows_left bigint")


@query("month_switch",
       f"WITH {sql_trips('l_tax')}, {RAW_SQL} SELECT destination, trip_key, line, fare FROM sorted")
def month_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month loaded, then landed anew without any flags. That load rejects all but surplus copies
    under the null rule and is refused after it wrote facts and rejects: the earlier month is still
    what every table holds."""
    layout = fresh_layout(spark)
    land(spark, sf_dir, layout)
    raw_plan.load_raw(spark, layout, MONTH, RANGE)
    # The same rows again: taken from where they landed, instead of from another join of the tables.
    landed, before = layout.landing_file(MONTH), scratch_path(spark)
    Store(spark, landed).rename(landed, before)
    flagless = spark.read.parquet(before).withColumn("store_and_fwd_flag", F.lit(None).cast("string"))
    flagless.write.parquet(landed)
    remove_scratch(spark, before)
    try:
        raw_plan.load_raw(spark, layout, MONTH, RANGE, most_rejected=0.99)
    except raw_plan.RejectedShareError:
        return destinations(read_partition(spark, layout.raw_facts, MONTH), raw_plan.LAYER, layout)
    raise AssertionError("a month without a good row was taken")


@query("silver_month", f"""
WITH {sql_trips('l_tax')}, {sql_zones(True)}, {SILVER_SQL}
SELECT destination, trip_key, line, fare FROM placed""")
def silver_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = fresh_layout(spark)
    write_raw(spark, sf_dir, layout)
    write_zones(spark, sf_dir, layout, partial=True)
    silver_plan.load_silver(spark, layout, MONTH)
    silver = read_partition(spark, layout.silver_facts, MONTH)
    return destinations(silver, silver_plan.LAYER, layout)


@query("replay_rejects", f"""
WITH {sql_trips('l_tax')}, {sql_zones()}, {SILVER_SQL}
SELECT destination, trip_key, line, fare FROM placed""")
def replay_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month loaded with a lookup that lacks a region, which is added afterwards: the rejects alone
    are judged again, and each row is where a full load with the whole lookup puts it."""
    layout = fresh_layout(spark)
    write_raw(spark, sf_dir, layout)
    write_zones(spark, sf_dir, layout, partial=True)
    silver_plan.load_silver(spark, layout, MONTH)
    zone_frame(spark, sf_dir).write.mode("overwrite").option("header", True).csv(layout.lookup)
    silver_plan.replay_rejects(spark, layout, MONTH)
    silver = read_partition(spark, layout.silver_facts, MONTH)
    return destinations(silver, silver_plan.LAYER, layout)


_MART_SQL = """
named AS (SELECT t.*, borough, zone FROM trips t LEFT JOIN zones ON pu = id),
hours AS (SELECT zone, CAST(hour(pickup) AS INTEGER) AS h, count(*) AS n FROM named GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY zone ORDER BY n DESC, h) AS r FROM hours)
SELECT 'avg_fare_per_mile' AS mart, borough AS name, CAST(NULL AS INTEGER) AS part,
       round(avg(fare / nullif(distance, 0)), 4) AS value FROM named GROUP BY 2
UNION ALL SELECT 'total_trips_count_per_zone', zone, NULL, CAST(count(*) AS DOUBLE)
  FROM named GROUP BY 2
UNION ALL SELECT 'trips_per_zone_per_hour', zone, h, CAST(n AS DOUBLE) FROM hours
UNION ALL SELECT 'trips_per_month', NULL, CAST(month(pickup) AS INTEGER), CAST(count(*) AS DOUBLE)
  FROM named GROUP BY 3
UNION ALL SELECT 'zone_wise_peak_hours', zone, h, CAST(r AS DOUBLE) FROM ranked WHERE r < 4"""


def read_marts(spark: SparkSession, layout: Layout) -> DataFrame:
    """The five aggregate tables in one long frame."""
    shapes = {
        GOLD_FARE: ("PUBorough", None, F.round("avg_fare_per_mile", 4)),
        GOLD_ZONE: ("PUZone", None, F.col("total_trip_count_per_zone")),
        GOLD_ZONE_HOUR: ("PUZone", "pickup_hour", F.col("trip_per_zone_per_hour")),
        GOLD_MONTH: (None, "pickup_month", F.col("trips_per_month")),
        GOLD_PEAK: ("PUZone", "pickup_hour", F.col("row_num")),
    }
    frames = [
        read_table(spark, layout.gold_table(mart)).select(
            F.lit(mart).alias("mart"),
            (F.col(name) if name else F.lit(None).cast("string")).alias("name"),
            (F.col(part) if part else F.lit(None)).cast("int").alias("part"),
            value.cast("double").alias("value"),
        )
        for mart, (name, part, value) in shapes.items()
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionAll(frame)
    return result


@query("gold_marts", f"WITH {sql_trips()}, {sql_zones(True)}, {_MART_SQL}")
def gold_marts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = fresh_layout(spark)
    write_silver(spark, sf_dir, layout)
    write_zones(spark, sf_dir, layout, partial=True)
    build_gold(spark, layout)
    return read_marts(spark, layout)


@query("gold_full", f"""
WITH {sql_trips()}, {sql_zones(True)}
SELECT trip_key, line, fare, CAST(year(pickup) AS INTEGER) AS year,
       CAST(month(pickup) AS INTEGER) AS month,
       p.borough AS pu_borough, p.zone AS pu_zone, d.borough AS do_borough, d.zone AS do_zone
FROM trips LEFT JOIN zones p ON pu = p.id LEFT JOIN zones d ON dof = d.id""")
def gold_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = fresh_layout(spark)
    write_silver(spark, sf_dir, layout)
    write_zones(spark, sf_dir, layout, partial=True)
    refresh_everything(spark, layout, read_lookup(spark, layout.lookup))
    return read_table(spark, layout.gold_table(GOLD_FULL)).select(
        *trip_id(), F.col("fare_amount").alias("fare"), "year", "month",
        F.col("PUBorough").alias("pu_borough"), F.col("PUZone").alias("pu_zone"),
        F.col("DOBorough").alias("do_borough"), F.col("DOZone").alias("do_zone"),
    )


@query("gold_incremental", f"""
WITH {sql_trips()}, {sql_zones(True)}
SELECT CAST(year(pickup) AS INTEGER) AS year, CAST(month(pickup) AS INTEGER) AS month, zone,
       count(*) AS trips, round(sum(fare), 2) AS fare
FROM trips LEFT JOIN zones ON pu = id GROUP BY 1, 2, 3""")
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold built without one month and with a month that silver loses again; then both are brought up
    to date, and the published table follows."""
    layout, name = fresh_layout(spark), f"full_{uuid.uuid4().hex}"
    write_zones(spark, sf_dir, layout, partial=True)
    write_silver(spark, sf_dir, layout)
    later = read_partition(spark, layout.silver_facts, MONTH)
    held = settle(later, scratch_path(spark))
    gone = RunKey(1990, 1)
    remove_month(spark, layout.silver_facts, MONTH)
    replace_month(held, layout.silver_facts, gone)
    build_gold(spark, layout)
    full = layout.gold_table(GOLD_FULL)
    register_table(spark, name, full, MONTH_KEYS)
    remove_month(spark, layout.silver_facts, gone)
    replace_month(held, layout.silver_facts, MONTH)
    build_gold(spark, layout)
    publish_month(spark, name, full, MONTH)
    return spark.table(name).groupBy("year", "month", F.col("PUZone").alias("zone")).agg(
        F.count(F.lit(1)).alias("trips"), F.round(F.sum("fare_amount"), 2).alias("fare")
    )


@query("monthly_run", f"""
WITH {sql_trips('l_tax')}, {RAW_SQL}, {sql_zones(True)},
judged AS (
  SELECT s.trip_key, s.line, s.destination, p.zone AS pu_zone,
         CASE WHEN dropoff < pickup THEN 'faulty_timestamps'
              WHEN passengers = 0 THEN 'faulty_passenger_count'
              WHEN distance = 0 THEN 'faulty_trip_distance'
              WHEN p.id IS NULL THEN 'faulty_pickup_locations'
              WHEN d.id IS NULL THEN 'faulty_dropoff_locations'
              ELSE 'silver' END AS judgement,
         p.id IS NULL AND d.id IS NULL AS both_unknown
  FROM sorted s LEFT JOIN zones p ON pu = p.id LEFT JOIN zones d ON dof = d.id)
SELECT 'raw' AS layer, destination, trip_key, line FROM judged
UNION ALL SELECT 'silver', judgement, trip_key, line FROM judged WHERE destination = 'raw'
UNION ALL SELECT 'silver', 'faulty_dropoff_locations', trip_key, line FROM judged
  WHERE destination = 'raw' AND judgement = 'faulty_pickup_locations' AND both_unknown
UNION ALL SELECT 'gold', pu_zone, trip_key, line FROM judged
  WHERE destination = 'raw' AND judgement = 'silver'""")
def monthly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers for one month; each row with the place it went to in each layer."""
    layout = fresh_layout(spark)
    land(spark, sf_dir, layout)
    write_zones(spark, sf_dir, layout, partial=True)
    run_month(spark, layout, MONTH, location_range=RANGE)
    layers = [
        destinations(read_partition(spark, root, MONTH), name, layout)
        .select(F.lit(name).alias("layer"), "destination", "trip_key", "line")
        for name, root in ((raw_plan.LAYER, layout.raw_facts),
                           (silver_plan.LAYER, layout.silver_facts))
    ]
    gold = read_table(spark, layout.gold_table(GOLD_FULL)).select(
        F.lit("gold").alias("layer"), F.col("PUZone").alias("destination"), *trip_id()
    )
    return layers[0].unionAll(layers[1]).unionAll(gold)
