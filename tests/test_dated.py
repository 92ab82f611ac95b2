"""Lookups with validity periods."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from tidemark.model import RunKey
from tidemark.operators import dated
from tidemark.operators import lookups
from tidemark.operators.dated import OverlapError, check_dated, enrich_as_of, month_slices
from test_physical_plans import plan

PERIODS = "LocationID int, Zone string, valid_from timestamp_ntz, valid_to timestamp_ntz"


def at(text):
    return datetime.datetime.fromisoformat(text) if text else None


def history(spark, *rows):
    return spark.createDataFrame([(k, z, at(a), at(b)) for k, z, a, b in rows], PERIODS)


ENTRIES = [
    (1, "old", None, "2024-02-10T12:00:00"),
    (1, "new", "2024-02-10T12:00:00", "2024-03-01"),
    (1, "last", "2024-05-01", None),
    (2, "always", None, None),
    (None, "nobody", None, None),
    (None, "nobody too", None, None),
]
TIMES = ["2024-01-01", "2024-02-10T11:59:59.999999", "2024-02-10T12:00:00", "2024-02-29T23:59:59", "2024-03-01", "2024-04-30T23:00:00", "2024-05-01", "2031-12-31", None]


def facts(spark):
    rows = [(k, 2, at(t), n) for n, (t, k) in enumerate((t, k) for t in TIMES for k in (1, 2, 3, None))]
    return spark.createDataFrame(rows, "PULocationID int, DOLocationID int, time timestamp_ntz, _key int")


def slow(key, time):
    for k, zone, start, end in ENTRIES:
        if k is not None and k == key and time is not None:
            if (start is None or time >= at(start)) and (end is None or time < at(end)):
                return zone
    return None


@pytest.mark.parametrize("limit", [None, 0])
def test_each_fact_has_the_entry_of_its_time(spark, monkeypatch, limit):
    if limit is not None:
        monkeypatch.setattr(lookups, "BROADCAST_BYTES", limit)
    found = enrich_as_of(facts(spark), check_dated(history(spark, *ENTRIES)), "time")
    rows = found.collect()
    assert len(rows) == len(TIMES) * 4 and "_key" in found.columns
    for r in rows:
        assert r.PUZone == slow(r.PULocationID, r.time) and r.DOZone == slow(2, r.time)
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert ("Exchange hashpartitioning" in text) == (limit == 0)


def test_slices_stay_within_the_months_of_the_facts(spark):
    lookup = check_dated(history(spark, *ENTRIES))
    slices = month_slices(lookup, RunKey(2024, 1), RunKey(2024, 6))
    counted = {tuple(r) for r in slices.groupBy("LocationID", "Zone").count().collect()}
    assert counted == {(1, "old", 2), (1, "new", 2), (1, "last", 2), (2, "always", 6)}


def test_no_times_and_no_facts(spark):
    lookup = check_dated(history(spark, *ENTRIES))
    timeless = facts(spark).where("time IS NULL")
    assert {r.PUZone for r in enrich_as_of(timeless, lookup, "time").collect()} == {None}
    assert enrich_as_of(facts(spark).limit(0), lookup, "time").count() == 0


@pytest.mark.parametrize("second", [
    (1, "b", "2024-01-15", None), (1, "b", None, None), (1, "b", None, "2023-01-01"),
    (1, "b", "2024-01-01", "2024-01-01"), (1, "b", "2024-03-01", "2024-02-01"),
])
def test_overlapping_or_empty_periods_are_refused(spark, second):
    with pytest.raises(OverlapError):
        check_dated(history(spark, (1, "a", "2023-06-01", "2024-02-01") if second[2:] != (None, "2023-01-01") else (1, "a", None, "2022-01-01"), second))


def test_an_open_period_before_another_is_refused(spark):
    with pytest.raises(OverlapError):
        check_dated(history(spark, (1, "a", "2023-01-01", None), (1, "b", "2024-01-01", "2025-01-01")))


def test_hidden_columns_are_refused(spark):
    lookup = check_dated(history(spark, *ENTRIES))
    with pytest.raises(ValueError, match="PUZone"):
        enrich_as_of(facts(spark).withColumn("PUZone", F.lit("x")), lookup, "time")
    assert re.search("valid", dated.__doc__)
