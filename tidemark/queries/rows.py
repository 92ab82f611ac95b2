"""Row-level operators: rules, copies, set differences, lookups and scalar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import (
    last_path_part,
    month_of_path,
    month_text,
    seconds_between,
    year_text,
)
from tidemark.model import (
    DROPOFF_LOCATION,
    DROPOFF_TIME,
    PICKUP_LOCATION,
    PICKUP_TIME,
    RULE_DISTANCE,
    RULE_LOCATIONS,
    RULE_NULLS,
    RULE_PASSENGERS,
    RULE_STRAY,
    RULE_TIMES,
)
from tidemark.operators import copies, dated, lookups, profile, rules
from tidemark.operators.reconcile import reconcile
from tidemark.plans.silver import classify_raw
from tidemark.queries.registry import query
from tidemark.queries.views import (
    MONTH,
    order_lines,
    select_trips,
    sql_trips,
    sql_zones,
    table,
    trips,
    zones,
)
from tidemark.sources.scratch import scratch_path, settle

def trip_id() -> tuple[Column, Column]:
    return F.col("trip_key"), F.col("VendorID").alias("line")


# --- copies and set differences -----------------------------------------------------------------

def _flags_and_quantity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")


@query("dedup_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.distinct_rows(_flags_and_quantity(spark, sf_dir))


@query("surplus_copies", """
SELECT l_returnflag, l_linestatus, l_quantity FROM lineitem
EXCEPT ALL
SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem""")
def surplus_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies.surplus_copies(_flags_and_quantity(spark, sf_dir))


@query("bag_difference", """
SELECT l_returnflag, l_quantity FROM lineitem
EXCEPT ALL
SELECT l_returnflag, l_quantity FROM lineitem WHERE l_linestatus = 'F'""")
def bag_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _flags_and_quantity(spark, sf_dir)
    pair = ("l_returnflag", "l_quantity")
    return copies.bag_difference(
        lines.select(*pair), lines.where(F.col("l_linestatus") == "F").select(*pair)
    )


@query("set_difference", """
SELECT l_returnflag, l_quantity FROM lineitem
EXCEPT
SELECT l_returnflag, l_quantity FROM lineitem WHERE l_quantity <= 25""")
def set_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_quantity")
    return copies.set_difference(lines, lines.where(F.col("l_quantity") <= 25))


# --- null, range, period, order and zero rules --------------------------------------------------

def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", "n_chars", "text"
    )
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


_LABELLED = """
SELECT d.doc_id, lang, source, n_chars, text, quality, toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id """
_ANY_NULL = """text IS NULL OR lang IS NULL OR source IS NULL OR n_chars IS NULL
   OR quality IS NULL OR toxic IS NULL"""


@query("drop_nulls", f"SELECT * FROM ({_LABELLED}) WHERE NOT ({_ANY_NULL})")
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _labelled_documents(spark, sf_dir)
    return rules.keep_rows(df, [rules.null_rule(RULE_NULLS, df.schema)])


@query("null_reject", f"SELECT * FROM ({_LABELLED}) WHERE {_ANY_NULL}")
def null_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _labelled_documents(spark, sf_dir)
    return rules.reject_rows(df, rules.null_rule(RULE_NULLS, df.schema))


def _range_rule() -> rules.Rule:
    return rules.range_rule(RULE_LOCATIONS, [PICKUP_LOCATION, DROPOFF_LOCATION], 1, 24)


def _places(df: DataFrame) -> DataFrame:
    return df.select(*trip_id(), F.col(PICKUP_LOCATION).alias("pu"), F.col(DROPOFF_LOCATION).alias("dof"))


@query("range_keep", f"""WITH {sql_trips()}
SELECT trip_key, line, pu, dof FROM trips WHERE pu BETWEEN 1 AND 24 AND dof BETWEEN 1 AND 24""")
def range_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(rules.keep_rows(trips(spark, sf_dir), [_range_rule()]))


@query("range_reject", f"""WITH {sql_trips()}
SELECT trip_key, line, pu, dof FROM trips
WHERE NOT (pu BETWEEN 1 AND 24 AND dof BETWEEN 1 AND 24)""")
def range_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(rules.reject_rows(trips(spark, sf_dir), _range_rule()))


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_trips(order_lines(spark, sf_dir))


def _times(df: DataFrame) -> DataFrame:
    return df.select(*trip_id(), F.col(PICKUP_TIME).alias("pickup"), F.col(DROPOFF_TIME).alias("dropoff"))


_TIMED = """
SELECT l_orderkey AS trip_key, l_linenumber AS line, o_orderdate AS pickup, l_shipdate AS dropoff
FROM lineitem JOIN orders ON l_orderkey = o_orderkey """
_IN_MONTH = "o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'"


@query("period_keep", f"{_TIMED} WHERE {_IN_MONTH}")
def period_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rules.month_rule(RULE_STRAY, PICKUP_TIME, MONTH)
    return _times(rules.keep_rows(_timed(spark, sf_dir), [rule]))


@query("period_reject", f"{_TIMED} WHERE NOT ({_IN_MONTH})")
def period_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rules.month_rule(RULE_STRAY, PICKUP_TIME, MONTH)
    return _times(rules.reject_rows(_timed(spark, sf_dir), rule))


@query("time_order_keep", f"{_TIMED} WHERE l_shipdate >= o_orderdate")
def time_order_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rules.order_rule(RULE_TIMES, PICKUP_TIME, DROPOFF_TIME)
    return _times(rules.keep_rows(_timed(spark, sf_dir), [rule]))


@query("time_order_reject", f"{_TIMED} WHERE l_shipdate < o_orderdate")
def time_order_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rules.order_rule(RULE_TIMES, PICKUP_TIME, DROPOFF_TIME)
    return _times(rules.reject_rows(_timed(spark, sf_dir), rule))


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_discount", "l_tax"
    )


@query("zero_keep", """
SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem
WHERE l_discount <> 0 AND l_tax <> 0""")
def zero_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = [rules.zero_rule(RULE_PASSENGERS, "l_discount"), rules.zero_rule(RULE_DISTANCE, "l_tax")]
    return rules.keep_rows(_rates(spark, sf_dir), both)


@query("zero_reject",
       "SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount = 0")
def zero_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = rules.zero_rule(RULE_PASSENGERS, "l_discount")
    return rules.reject_rows(_rates(spark, sf_dir), rule)


# --- lookups ------------------------------------------------------------------------------------

def _pickups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return select_trips(order_lines(spark, sf_dir, pickup=True))


def _dropoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and suppliers only: the dropoff check needs nothing of the order."""
    lines, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    return lines.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("trip_key"),
        F.col("l_linenumber").alias("VendorID"),
        F.col("s_nationkey").alias(DROPOFF_LOCATION),
    )


_PICKUPS = """
SELECT l_orderkey AS trip_key, l_linenumber AS line, c_nationkey AS location
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey {test} IN (SELECT id FROM zones)"""
_DROPOFFS = """
SELECT l_orderkey AS trip_key, l_linenumber AS line, s_nationkey AS location
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
WHERE s_nationkey {test} IN (SELECT id FROM zones)"""


@query("orphan_pickup", f"WITH {sql_zones(True)} {_PICKUPS.format(test='NOT')}")
def orphan_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.orphans(_pickups(spark, sf_dir), PICKUP_LOCATION, zones(spark, sf_dir, True))
    return rows.select(*trip_id(), F.col(PICKUP_LOCATION).alias("location"))


@query("orphan_dropoff", f"WITH {sql_zones(True)} {_DROPOFFS.format(test='NOT')}")
def orphan_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.orphans(_dropoffs(spark, sf_dir), DROPOFF_LOCATION, zones(spark, sf_dir, True))
    return rows.select(*trip_id(), F.col(DROPOFF_LOCATION).alias("location"))


@query("matched_pickup", f"WITH {sql_zones(True)} {_PICKUPS.format(test='')}")
def matched_pickup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.matched(_pickups(spark, sf_dir), PICKUP_LOCATION, zones(spark, sf_dir, True))
    return rows.select(*trip_id(), F.col(PICKUP_LOCATION).alias("location"))


@query("matched_dropoff", f"WITH {sql_zones(True)} {_DROPOFFS.format(test='')}")
def matched_dropoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lookups.matched(_dropoffs(spark, sf_dir), DROPOFF_LOCATION, zones(spark, sf_dir, True))
    return rows.select(*trip_id(), F.col(DROPOFF_LOCATION).alias("location"))


_ENRICHED = """
SELECT trip_key, line, fare, p.borough AS pu_borough, p.zone AS pu_zone,
       d.borough AS do_borough, d.zone AS do_zone
FROM trips LEFT JOIN zones p ON pu = p.id LEFT JOIN zones d ON dof = d.id"""


def _enriched(spark: SparkSession, sf_dir: str, partial: bool) -> DataFrame:
    return lookups.enrich(trips(spark, sf_dir), zones(spark, sf_dir, partial)).select(
        *trip_id(), F.col("fare_amount").alias("fare"),
        F.col("PUBorough").alias("pu_borough"), F.col("PUZone").alias("pu_zone"),
        F.col("DOBorough").alias("do_borough"), F.col("DOZone").alias("do_zone"),
    )


@query("enriched_full", f"WITH {sql_trips()}, {sql_zones()} {_ENRICHED}")
def enriched_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, partial=False)


@query("enriched_unmatched", f"WITH {sql_trips()}, {sql_zones(True)} {_ENRICHED}")
def enriched_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some locations have no zone: those trips stay, with NULL attributes."""
    return _enriched(spark, sf_dir, partial=True)


# --- the classifier -----------------------------------------------------------------------------

SILVER_SQL = """
flagged AS (
  SELECT t.*, p.id IS NULL AS no_pu, d.id IS NULL AS no_do
  FROM trips t LEFT JOIN zones p ON pu = p.id LEFT JOIN zones d ON dof = d.id),
sequential AS MATERIALIZED (
  SELECT *, CASE WHEN dropoff < pickup THEN 'faulty_timestamps'
                 WHEN passengers = 0 THEN 'faulty_passenger_count'
                 WHEN distance = 0 THEN 'faulty_trip_distance' END AS rule
  FROM flagged),
placed AS MATERIALIZED (
  SELECT *, rule AS destination FROM sequential WHERE rule IS NOT NULL
  UNION ALL
  SELECT *, 'faulty_pickup_locations' FROM sequential WHERE rule IS NULL AND no_pu
  UNION ALL
  SELECT *, 'faulty_dropoff_locations' FROM sequential WHERE rule IS NULL AND no_do
  UNION ALL
  SELECT *, 'silver' FROM sequential WHERE rule IS NULL AND NOT no_pu AND NOT no_do)"""


@query("silver_classified", f"""
WITH {sql_trips('l_tax')}, {sql_zones(True)}, {SILVER_SQL}
SELECT destination, trip_key, line, fare FROM placed""")
def silver_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = trips(spark, sf_dir, "l_tax")
    placed = classify_raw(facts, zones(spark, sf_dir, partial=True))
    return placed.select("destination", *trip_id(), F.col("fare_amount").alias("fare"))


# --- times within a day -------------------------------------------------------------------------

_TIMED_EVENTS = """
timed AS (SELECT event_id, ts AS pickup, ts + to_microseconds((event_id % 7 - 3) * 400000) AS dropoff
          FROM events)"""


def timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips that end up to 1.2 seconds before or after they start."""
    shift = F.expr("(event_id % 7 - 3) * 0.4")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias(PICKUP_TIME),
        (F.col("ts") + F.make_dt_interval(secs=shift)).alias(DROPOFF_TIME),
    )


@query("event_seconds", f"""
WITH {_TIMED_EVENTS}
SELECT event_id, CAST(date_diff('second', pickup, dropoff) AS BIGINT) AS seconds FROM timed""")
def event_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ends are cut to whole seconds before they are compared."""
    seconds = seconds_between(F.col(PICKUP_TIME), F.col(DROPOFF_TIME))
    return timed_events(spark, sf_dir).select("event_id", seconds.alias("seconds"))


@query("event_time_order", f"""
WITH {_TIMED_EVENTS}
SELECT event_id, date_diff('second', pickup, dropoff) >= 0 AS kept FROM timed""")
def event_time_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips that end in an earlier second than they start in are rejected, equal seconds kept."""
    events = timed_events(spark, sf_dir)
    order = rules.order_rule(RULE_TIMES, PICKUP_TIME, DROPOFF_TIME)
    kept = rules.keep_rows(events, [order]).select("event_id", F.lit(True).alias("kept"))
    rejects = rules.reject_rows(events, order).select("event_id", F.lit(False).alias("kept"))
    return kept.unionAll(rejects)


# --- scalar expressions -------------------------------------------------------------------------

@query("duration_seconds", """
SELECT l_orderkey AS trip_key, l_linenumber AS line,
       CAST(date_diff('second', o_orderdate, l_shipdate) AS BIGINT) AS seconds
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def duration_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = seconds_between(F.col(PICKUP_TIME), F.col(DROPOFF_TIME))
    return _timed(spark, sf_dir).select(*trip_id(), seconds.alias("seconds"))


@query("year_month_text", """
SELECT strftime(o_orderdate, '%Y') AS year_text, strftime(o_orderdate, '%m') AS month_text,
       count(*) AS orders
FROM orders GROUP BY 1, 2""")
def year_month_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(year_text(at).alias("year_text"), month_text(at).alias("month_text"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


@query("file_key", """
SELECT 'facts_' || strftime(o_orderdate, '%Y-%m') || '.parquet' AS file_name,
       CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(*) AS orders
FROM orders GROUP BY 1, 2, 3""")
def file_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per path first; the path functions then run once per path."""
    at = F.col("o_orderdate")
    path = F.concat(F.lit("landing/facts_"), F.date_format(at, "yyyy-MM"), F.lit(".parquet"))
    year, month = month_of_path(F.col("path"))
    counted = (
        table(spark, sf_dir, "orders").groupBy(path.alias("path"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return counted.select(
        last_path_part(F.col("path")).alias("file_name"), year.alias("year"), month.alias("month"),
        "orders",
    )


# --- lookup with history, and reconciliation ----------------------------------------------------

DATED_SQL = f"""
{sql_zones()},
dated AS (
  SELECT id, borough, zone, CAST(NULL AS TIMESTAMP) AS since, TIMESTAMP '1995-07-01' AS until
  FROM zones WHERE id % 3 = 0
  UNION ALL SELECT id, borough, zone || ' II', TIMESTAMP '1995-07-01', NULL FROM zones WHERE id % 3 = 0
  UNION ALL SELECT id, borough, zone, NULL, CASE WHEN id % 3 = 1 THEN TIMESTAMP '1997-01-01' END
  FROM zones WHERE id % 3 <> 0)"""


@query("enriched_as_of", f"""
WITH {sql_trips()}, {DATED_SQL}
SELECT trip_key, line, p.zone AS pu_zone, d.borough AS do_borough, d.zone AS do_zone
FROM trips
LEFT JOIN dated p ON pu = p.id AND (p.since IS NULL OR pickup >= p.since)
  AND (p.until IS NULL OR pickup < p.until)
LEFT JOIN dated d ON dof = d.id AND (d.since IS NULL OR pickup >= d.since)
  AND (d.until IS NULL OR pickup < d.until)""")
def enriched_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the zones was renamed once, another third was given up: each trip has the names of
    its time."""
    entries = zones(spark, sf_dir).frame
    third = F.col("LocationID") % 3

    def moment(text: str | None) -> Column:
        return F.lit(text).cast("timestamp_ntz")

    def valid(frame: DataFrame, since: Column, until: Column) -> DataFrame:
        return frame.withColumns({dated.VALID_FROM: since, dated.VALID_TO: until})

    renamed = entries.where(third == 0)
    history = (
        valid(renamed, moment(None), moment("1995-07-01"))
        .unionByName(valid(renamed.withColumn("Zone", F.concat("Zone", F.lit(" II"))), moment("1995-07-01"), moment(None)))
        .unionByName(valid(entries.where(third != 0), moment(None), F.when(third == 1, moment("1997-01-01"))))
    )
    found = dated.enrich_as_of(trips(spark, sf_dir), dated.check_dated(history), PICKUP_TIME)
    return found.select(
        *trip_id(), F.col("PUZone").alias("pu_zone"), F.col("DOBorough").alias("do_borough"),
        F.col("DOZone").alias("do_zone"),
    )


@query("reconcile", f"""
WITH {sql_trips()},
one AS (SELECT trip_key, line, fare FROM trips),
other AS (
  SELECT trip_key, line, CASE WHEN trip_key % 777 = 0 THEN fare + 1 ELSE fare END AS fare
  FROM trips WHERE trip_key % 1000 <> 0
  UNION ALL SELECT trip_key, line, fare FROM trips WHERE line = 7 AND trip_key % 50 = 1)
SELECT side, count(*) AS copies, trip_key, line, fare FROM (
  SELECT 'left' AS side, * FROM (SELECT * FROM one EXCEPT ALL SELECT * FROM other)
  UNION ALL SELECT 'right', * FROM (SELECT * FROM other EXCEPT ALL SELECT * FROM one))
GROUP BY side, trip_key, line, fare""")
def reconcile_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two states of the trips: rows lost, changed and doubled, from both sides."""
    one = trips(spark, sf_dir).select(*trip_id(), F.col("fare_amount").alias("fare"))
    key = F.col("trip_key")
    other = one.where(key % 1000 != 0).withColumn(
        "fare", F.when(key % 777 == 0, F.col("fare") + 1).otherwise(F.col("fare"))
    )
    doubled = one.where((F.col("line") == 7) & (key % 50 == 1))
    return reconcile(one, other.unionAll(doubled))


# --- drift of values ----------------------------------------------------------------------------

_PROFILED = ("quantity", "price", "discount")


@query("value_drift", """
WITH lines AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, l_quantity AS quantity,
         CASE WHEN year(o_orderdate) = 1998 THEN 3 * l_extendedprice ELSE l_extendedprice END AS price,
         CASE WHEN year(o_orderdate) <> 1997 OR l_linenumber > 1 THEN l_discount END AS discount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
long AS (
  SELECT year, 'quantity' AS "column", quantity AS v FROM lines
  UNION ALL SELECT year, 'price', price FROM lines UNION ALL SELECT year, 'discount', discount FROM lines),
earlier AS (
  SELECT "column", quantile_cont(v, 0.25) AS low, quantile_cont(v, 0.5) AS middle, quantile_cont(v, 0.75) AS high
  FROM long WHERE year < 1997 GROUP BY 1),
later AS (
  SELECT year, "column", count(*) - count(v) AS nulls, count(*) AS n, quantile_cont(v, 0.25) AS low,
         quantile_cont(v, 0.5) AS middle, quantile_cont(v, 0.75) AS high
  FROM long WHERE year >= 1997 GROUP BY 1, 2)
SELECT year, l."column", round(nulls / n, 6) AS null_share,
       greatest(abs(l.low - e.low), abs(l.middle - e.middle), abs(l.high - e.high)) > 0.5 * (e.high - e.low) AS moved
FROM later l JOIN earlier e ON l."column" = e."column"
""")
def value_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines profiled by year in one pass; years from 1997 on are compared with the merged profile of
    the years before. Prices of 1998 are in another unit, and discounts of 1997 are partly missing."""
    year = F.year("o_orderdate")
    lines = order_lines(spark, sf_dir).select(
        year.alias("year"),
        F.col("l_quantity").alias("quantity"),
        F.when(year == 1998, 3 * F.col("l_extendedprice")).otherwise(F.col("l_extendedprice")).alias("price"),
        F.when((year != 1997) | (F.col("l_linenumber") > 1), F.col("l_discount")).alias("discount"),
    )
    profiles = settle(profile.profile(lines, ["year"], _PROFILED), scratch_path(spark))
    earlier = profile.merge(profiles.where("year < 1997"))
    found = profile.value_drift(earlier, profiles.where("year >= 1997"), ["year"])
    return found.select("year", "column", F.round("null_share", 6).alias("null_share"), "moved")
