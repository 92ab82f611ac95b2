"""Profiles of values: sketches per month, merged, and the drift between them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile as p


def table(spark, rows=20_000):
    rng = random.Random(3)
    data = [
        (n % 4, rng.gauss(50, 10), rng.randrange(1000), rng.choice(["a", "b", None]), None, float("nan") if n % 2 else 1.0, [n % 3], n)
        for n in range(rows)
    ]
    return spark.createDataFrame(data, "month int, `a.b` double, k int, s string, none double, nan double, list array<int>, _columns int").repartition(5)


def test_quartiles_and_counts_are_within_their_bounds(spark):
    df = table(spark)
    rows = {r["column"]: r for r in p.summary(p.profile(df)).collect()}
    assert set(rows) == set(df.columns)
    for name in ("a.b", "k", "_columns"):
        values = sorted(r[0] for r in df.select(f"`{name}`").collect())
        for quantile, found in zip(p.QUANTILES, (rows[name]["low"], rows[name]["middle"], rows[name]["high"])):
            rank = sum(v <= found for v in values) / len(values)
            below = sum(v < found for v in values) / len(values)
            assert below - p.RANK_ERROR <= quantile <= rank + p.RANK_ERROR
    assert math.isclose(rows["k"]["distinct"], 1000, rel_tol=0.06)
    assert rows["s"]["distinct"] == 2 and rows["list"]["distinct"] == 3 and rows["none"]["distinct"] == 0
    assert rows["s"]["nulls"] == df.where("s IS NULL").count() and rows["none"]["nulls"] == rows["none"]["rows"] == 20_000
    assert rows["s"]["middle"] is None and rows["none"]["low"] is None and rows["nan"]["middle"] == 1.0


def test_merged_months_are_the_whole(spark):
    df = table(spark)
    months = p.profile(df, ["month"])
    assert months.count() == 4 * (len(df.columns) - 1)
    merged = {r["column"]: r for r in p.summary(p.merge(months)).collect()}
    whole = {r["column"]: r for r in p.summary(p.profile(df.drop("month"))).collect()}
    for name, row in whole.items():
        assert (merged[name]["rows"], merged[name]["nulls"]) == (row["rows"], row["nulls"])
        assert merged[name]["distinct"] == row["distinct"]
    span = whole["a.b"]["high"] - whole["a.b"]["low"]
    assert abs(merged["a.b"]["middle"] - whole["a.b"]["middle"]) < 0.15 * span


def test_profiles_are_stored_and_compared_later(spark, tmp_path):
    df = table(spark)
    p.profile(df, ["month"]).write.parquet(str(tmp_path / "p"))
    stored = spark.read.parquet(str(tmp_path / "p"))
    earlier = p.merge(stored.where("month < 3"))
    calm = p.value_drift(earlier, stored.where("month = 3"), ["month"])
    assert not any(r["moved"] for r in calm.where("column <> '_columns'").collect())
    doubled = p.profile(df.where("month = 3").withColumn("a.b", F.col("`a.b`") * 2), ["month"])
    moved = {r["column"]: r for r in p.value_drift(earlier, doubled, ["month"]).collect()}
    assert moved["a.b"]["moved"] and not moved["k"]["moved"] and not moved["s"]["moved"]
    assert math.isclose(moved["a.b"]["median"] / moved["a.b"]["median_before"], 2, rel_tol=0.05)


def test_one_shuffle_of_sketches(spark):
    plan = p.profile(table(spark, 100), ["month"])._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "Aggregate" in below.split("Exchange RoundRobin")[0] and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("by", [[], ["month"]])
def test_empty_table(spark, by):
    empty = table(spark, 10).limit(0)
    found = p.summary(p.profile(empty, by)).collect()
    assert len(found) == (0 if by else len(empty.columns)) and all(r["rows"] == 0 and r["low"] is None for r in found)
