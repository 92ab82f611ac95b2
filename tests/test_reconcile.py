"""Two tables compared by bucket checksums, silver's conservation, and the replay of rejects."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.reconcile import bucket_checksums, differing_buckets, reconcile
from tidemark.plans.raw import load_raw
from tidemark.plans.silver import ReplayError, load_silver, replay_rejects, unplaced_rows
from tidemark.sinks.tables import read_quarantine
from tidemark.sources.facts import read_partition
from trips import KEY, ZONES, frame, land, raw_frame, raw_trip, trip, write_lookup, write_raw
from test_physical_plans import plan

SHAPE = "k int, `a.b` string, _bucket double"


def rows_of(seed):
    rng = random.Random(seed)
    values = [None, "x", "y", ""]
    numbers = [None, 0.0, -0.0, 1.5, float("nan")]
    return [(rng.choice([None, 1, 2, 3]), rng.choice(values), rng.choice(numbers)) for _ in range(60)]


def same(row):
    """As Spark groups: NaN equals NaN, and zeros are one."""
    return tuple("nan" if v != v else v + 0.0 if isinstance(v, float) else v for v in row)


@pytest.mark.parametrize("buckets", [1, 7, 1 << 14])
def test_differences_equal_counting(spark, buckets):
    left, right = rows_of(1), rows_of(2)
    found = reconcile(spark.createDataFrame(left, SHAPE), spark.createDataFrame(right, SHAPE), buckets)
    assert found.columns == ["side", "copies", "k", "a.b", "_bucket"]
    one, other = Counter(map(same, left)), Counter(map(same, right))
    expected = {("left", n, *r) for r, n in (one - other).items()} | {("right", n, *r) for r, n in (other - one).items()}
    assert {(r[0], r[1], *same(r[2:])) for r in found.collect()} == expected


def test_equal_tables_shuffle_no_row(spark):
    left = spark.range(5000).selectExpr("id", "string(id % 7) AS s", "id / 3 AS d").repartition(7)
    right = left.orderBy(F.desc("id"))
    assert differing_buckets(left, right).isEmpty()
    assert reconcile(left, right).isEmpty()
    # Only rows that the broadcast buckets let through are dealt by their columns.
    text = plan(reconcile(left, right))
    whole = text.index("Exchange hashpartitioning(id")
    assert text.index("BroadcastHashJoin", whole) > whole and "LeftSemi" in text
    assert bucket_checksums(left).count() <= 1 << 14


def test_only_the_differing_bucket_is_compared(spark):
    left = spark.range(5000)
    changed = left.withColumn("id", F.when(F.col("id") == 77, 9_999_999).otherwise(F.col("id")))
    assert differing_buckets(left, changed).count() in (1, 2)
    assert {tuple(r) for r in reconcile(left, changed).collect()} == {("left", 1, 77), ("right", 1, 9_999_999)}


def test_empty_sides(spark):
    some, none = spark.range(3), spark.range(0)
    assert reconcile(none, none).isEmpty()
    assert {r["side"] for r in reconcile(some, none).collect()} == {"left"}
    assert reconcile(none, some).count() == 3


RAW = [
    raw_trip(1), raw_trip(2, PULocationID=50), raw_trip(3, DOLocationID=50), raw_trip(4, PULocationID=50, DOLocationID=51),
    raw_trip(5, PULocationID=99, DOLocationID=99), raw_trip(6, passenger_count=0, PULocationID=50),
    raw_trip(7, PULocationID=50, DOLocationID=99),
]
GROWN = [*ZONES, (50, "B", "fifty", None), (51, "B", "fifty-one", None)]


def state(spark, layout):
    silver = read_partition(spark, layout.silver_facts, KEY).select("total_amount", F.lit("silver"))
    rejects = read_quarantine(spark, layout.quarantine, "silver").select("total_amount", "rule")
    return Counter(tuple(r) for r in silver.unionAll(rejects).collect())


def test_replayed_rejects_equal_a_full_load(spark, layout):
    write_raw(raw_frame(spark, RAW).withColumn("_hit", F.lit("own")), layout)
    write_lookup(spark, layout)
    load_silver(spark, layout, KEY)
    before = state(spark, layout)
    assert before[(4.0, "faulty_pickup_locations")] == before[(4.0, "faulty_dropoff_locations")] == 1
    assert replay_rejects(spark, layout, KEY).rejected == load_silver(spark, layout, KEY).rejected
    assert state(spark, layout) == before
    write_lookup(spark, layout, GROWN)
    report = replay_rejects(spark, layout, KEY)
    replayed = state(spark, layout)
    assert report.kept == 4 and replayed[(7.0, "faulty_dropoff_locations")] == 1
    assert unplaced_rows(spark, layout, KEY).isEmpty()
    assert {r["_hit"] for r in read_partition(spark, layout.silver_facts, KEY).collect()} == {"own"}
    full = load_silver(spark, layout, KEY)
    assert state(spark, layout) == replayed and (full.kept, full.rejected) == (report.kept, report.rejected)


def test_replay_reads_no_raw_and_needs_a_grown_lookup(spark, layout, monkeypatch):
    write_raw(raw_frame(spark, RAW), layout)
    write_lookup(spark, layout)
    load_silver(spark, layout, KEY)
    held = state(spark, layout)
    write_lookup(spark, layout, [z for z in GROWN if z[0] != RAW[0]["PULocationID"]])
    with pytest.raises(ReplayError, match="lost"):
        replay_rejects(spark, layout, KEY)
    assert state(spark, layout) == held


def test_replay_is_refused_when_raw_is_newer(spark, layout):
    land(frame(spark, [trip(1)]), layout)
    load_raw(spark, layout, KEY)
    write_lookup(spark, layout)
    load_silver(spark, layout, KEY)
    assert replay_rejects(spark, layout, KEY).kept == 1
    load_raw(spark, layout, KEY)
    with pytest.raises(ReplayError, match="raw"):
        replay_rejects(spark, layout, KEY)


def test_unplaced_rows_are_found(spark, layout):
    write_raw(raw_frame(spark, RAW), layout)
    write_lookup(spark, layout)
    load_silver(spark, layout, KEY)
    assert unplaced_rows(spark, layout, KEY).isEmpty()
    write_raw(raw_frame(spark, [*RAW, raw_trip(70)]), layout)
    assert [(r["side"], r["total_amount"]) for r in unplaced_rows(spark, layout, KEY).collect()] == [("left", 70.0)]
