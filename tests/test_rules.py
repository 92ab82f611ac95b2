"""The classifier against the set-operation form of the same rules, on generated and given rows."""

from collections import Counter
from functools import reduce

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.model import (
    DROPOFF_LOCATION,
    DROPOFF_TIME,
    PICKUP_LOCATION,
    PICKUP_TIME,
    RULE_DISTANCE,
    RULE_DROPOFF,
    RULE_PASSENGERS,
    RULE_PICKUP,
    RULE_TIMES,
)
from tidemark.operators import rules
from tidemark.operators.lookups import check_lookup
from tidemark.plans.raw import RULES as RAW_RULES
from tidemark.plans.raw import landing_rules, split_landing
from tidemark.plans.silver import POSITION, split_raw
from tidemark.plans.silver import RULES as SILVER_RULES
from tidemark.queries.views import MONTH, landed_trips, trips, zone_frame, zones
from tidemark.sources.facts import SOURCE_FILE
from tidemark.sources.scratch import scratch_path, settle
from trips import KEY, at, frame, raw_frame, raw_trip, trip


def bag(df: DataFrame) -> Counter:
    """Rows as a multiset; NaN equals NaN and -0.0 equals 0.0, as in Spark's set operations."""
    def plain(value):
        if isinstance(value, float):
            return "nan" if value != value else value + 0.0
        return value

    return Counter(tuple(map(plain, row)) for row in df.select(sorted(df.columns)).collect())


def step(df: DataFrame) -> DataFrame:
    """A set operation's result as a table: nested, their plans grow beyond use."""
    return settle(df, scratch_path(df.sparkSession))


def silver_by_set_operations(raw: DataFrame, lookup: DataFrame) -> dict[str, DataFrame]:
    """The slow twin: find the bad rows of each rule and subtract them."""
    known = [r[0] for r in lookup.where("Zone IS NOT NULL").select("LocationID").collect()]
    second = [F.date_trunc("SECOND", c) for c in (PICKUP_TIME, DROPOFF_TIME)]
    out = {}
    for name, bad in ((RULE_TIMES, second[1] < second[0]),
                      (RULE_PASSENGERS, F.col("passenger_count") == 0),
                      (RULE_DISTANCE, F.col("trip_distance") == 0)):
        out[name] = raw.where(bad)
        raw = step(raw.subtract(out[name]))
    for name, column in ((RULE_PICKUP, PICKUP_LOCATION), (RULE_DROPOFF, DROPOFF_LOCATION)):
        out[name] = raw.where(F.coalesce(~F.col(column).isin(known), F.lit(True)))
    out["silver"] = raw.subtract(out[RULE_PICKUP]).subtract(out[RULE_DROPOFF])
    return out


def raw_by_set_operations(landing: DataFrame, low: int, high: int, month: Column) -> dict:
    distinct = step(landing.dropDuplicates())
    out = {"dropped_duplicates": landing.exceptAll(distinct)}
    full = step(distinct.dropna())
    out["dropped_nulls"] = distinct.subtract(full)
    inside = step(full.where(F.col(PICKUP_LOCATION).between(low, high)
                             & F.col(DROPOFF_LOCATION).between(low, high)))
    out["dropped_locations"] = full.subtract(inside)
    out["raw"] = inside.where(month)
    out["dropped_stray_timestamps"] = inside.subtract(out["raw"])
    return out


def check_raw(landing, key, low, high, stage):
    landing = step(landing)
    month = F.date_format(PICKUP_TIME, "yyyy-MM") == str(key)
    slow = raw_by_set_operations(landing, low, high, month)
    split = split_landing(landing, landing_rules(landing, key, (low, high)), stage)
    kept, rejects = step(split.kept.drop(SOURCE_FILE)), step(split.rejects)
    surplus = Counter() if split.surplus is None else bag(split.surplus)
    assert bag(kept) == bag(slow["raw"])
    assert surplus == bag(slow["dropped_duplicates"])
    for rule in RAW_RULES[1:]:
        assert bag(rejects.where(F.col("rule") == rule).drop("rule")) == bag(slow[rule]), rule
    assert bag(kept) + bag(rejects.drop("rule")) + surplus == bag(landing)


def check_silver(raw, lookup):
    raw = step(raw)
    slow = silver_by_set_operations(raw, lookup.frame)
    split = split_raw(raw, lookup)
    rejects = step(split.rejects.drop(*POSITION))
    assert bag(split.kept) == bag(slow["silver"])
    for rule in SILVER_RULES:
        assert bag(rejects.where(F.col("rule") == rule).drop("rule")) == bag(slow[rule]), rule


def test_raw_split_equals_set_operations_on_trips(spark, tmp_path):
    landing = landed_trips(spark, "/root/testdata/sf0.001")
    check_raw(landing, MONTH, 1, 24, str(tmp_path / "stage"))


def test_silver_split_equals_set_operations_on_trips(spark):
    sf = "/root/testdata/sf0.001"
    check_silver(trips(spark, sf, "l_tax"), zones(spark, sf, partial=True))


LANDED = st.fixed_dictionaries({
    "VendorID": st.sampled_from([None, 1]),
    "fare_amount": st.sampled_from([float("nan"), 1.0, -0.0, 0.0]),
    "PULocationID": st.sampled_from([None, 0, 1, 266, 267]),
    "DOLocationID": st.sampled_from([1, 300]),
    "tpep_pickup_datetime": st.sampled_from(
        [at("2024-01-31 23:59:59.999999"), at("2024-02-01 00:00:00"), at("2023-12-31 00:00:00")]),
})
SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(LANDED, min_size=1, max_size=25))
def test_raw_split_equals_set_operations(spark, tmp_path_factory, changes):
    landing = frame(spark, [trip(1, **c) for c in changes])
    check_raw(landing, KEY, 1, 266, str(tmp_path_factory.mktemp("stage")))


RAW = st.fixed_dictionaries({
    "tpep_dropoff_datetime": st.sampled_from(
        [None, at("2024-01-10 07:59:59.9"), at("2024-01-10 08:00:00"), at("2024-01-10 08:00:00.5")]),
    "tpep_pickup_datetime": st.sampled_from(
        [None, at("2024-01-10 08:00:00"), at("2024-01-10 08:00:00.7")]),
    "passenger_count": st.sampled_from([None, 0, 1]),
    "trip_distance": st.sampled_from([None, 0.0, -0.0, float("nan"), -1.0]),
    "PULocationID": st.sampled_from([None, 1, 4, 5]),
    "DOLocationID": st.sampled_from([None, 1, 4, 5]),
})


@SETTINGS
@given(st.lists(RAW, min_size=1, max_size=25))
def test_silver_split_equals_set_operations(spark, changes):
    lookup = check_lookup(spark.createDataFrame(
        [(1, "B", "Z", "s"), (4, "B", None, "s")],
        "LocationID int, Borough string, Zone string, service_zone string"))
    check_silver(raw_frame(spark, [raw_trip(i, **c) for i, c in enumerate(changes)]), lookup)


@pytest.mark.parametrize("null_is_bad", [True, False])
def test_keep_and_reject_are_complements(spark, null_is_bad):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    rule = rules.Rule("r", F.col("x") > 1, null_is_bad)
    kept = {r[0] for r in rules.keep_rows(df, [rule]).collect()}
    bad = {r[0] for r in rules.reject_rows(df, rule).collect()}
    assert kept == ({1} if null_is_bad else {1, None})
    assert bad == ({2, None} if null_is_bad else {2})


def test_every_reason_is_one_of_the_rules(spark):
    sf = "/root/testdata/sf0.001"
    df = zone_frame(spark, sf)
    names = [rules.Rule(str(i), F.col("LocationID") % (i + 2) == 0) for i in range(3)]
    out = rules.classify(df, names[:1], names[1:])
    flat = reduce(set.union, (set(r["_reasons"]) for r in out.collect()))
    assert flat == {"0", "1"} or flat == {"0", "1", "2"}
