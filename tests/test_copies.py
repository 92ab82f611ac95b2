"""Copies and set differences."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.copies import (
    BLOCK,
    COPIES,
    SMALL,
    bag_difference,
    fingerprint,
    repeated_fingerprints,
    replicate,
    set_difference,
    surplus_copies,
)

NAN = float("nan")
LEFT = [(1, "a", 0.0), (1, "a", -0.0), (1, "a", 0.0), (None, "b", NAN), (None, "b", NAN),
        (2, None, 1.0), (3, "c", 2.0)]
RIGHT = [(1, "a", -0.0), (None, "b", NAN), (3, "c", 2.0), (9, "z", 9.0)]
SCHEMA = "k int, s string, d double"


def bag(df):
    return Counter((r[0], r[1], "nan" if r[2] != r[2] else r[2] + 0.0) for r in df.collect())


@pytest.fixture
def left(spark):
    return spark.createDataFrame(LEFT, SCHEMA)


@pytest.fixture
def right(spark):
    return spark.createDataFrame(RIGHT, SCHEMA)


def test_surplus_copies(left):
    assert bag(surplus_copies(left)) == Counter({(1, "a", 0.0): 2, (None, "b", "nan"): 1})
    assert bag(surplus_copies(left)) == bag(left.exceptAll(left.dropDuplicates()))


def test_bag_difference(left, right):
    assert bag(bag_difference(left, right)) == bag(left.exceptAll(right))


def test_set_difference(left, right):
    assert bag(set_difference(left, right)) == bag(left.subtract(right))


@pytest.mark.parametrize("copies", [0, -3, 1, 2, SMALL, SMALL + 1, BLOCK, BLOCK + 1, 3 * BLOCK - 1])
def test_replicate_writes_every_copy(spark, copies):
    df = spark.createDataFrame([("x", copies), ("y", 2)], f"v string, {COPIES} bigint")
    found = {r["v"]: r["count"] for r in replicate(df).groupBy("v").count().collect()}
    assert found == {k: n for k, n in {"x": copies, "y": 2}.items() if n > 0}


def test_hot_group_is_written_by_several_tasks(spark):
    """One row makes up nearly the whole table; its copies must not end up in one task."""
    rows = 20 * BLOCK
    df = spark.range(rows).select(F.when(F.col("id") < 10, F.col("id")).otherwise(-1).alias("k"))
    surplus = surplus_copies(df)
    tasks = surplus.groupBy(F.spark_partition_id()).count().collect()
    assert sum(t["count"] for t in tasks) == rows - 11
    assert len(tasks) >= 4 and max(t["count"] for t in tasks) < rows / 2


def test_equal_rows_share_a_fingerprint(left):
    prints = left.select("k", "s", fingerprint(left.columns).alias("fp")).distinct()
    assert prints.count() == 4
    assert repeated_fingerprints(left, left.columns).count() == 2
