"""Wide lines are joined without a sort and moved once, before they widen; the rows are the same."""

import datetime
from collections import Counter

import pytest
from pyspark.sql import functions as F

from test_physical_plans import plan
from tidemark.queries import layers, views
from tidemark.sinks import tables
from tidemark.sources.facts import read_table

DAY = datetime.datetime(1996, 3, 1)
TABLES = {
    "customer": ("c_custkey long, c_nationkey int, c_name string", [(1, 7, "a"), (2, 8, "b"), (2, 9, "b"), (None, 1, "n")]),
    "supplier": ("s_suppkey long, s_nationkey int, s_name string", [(1, 3, "a"), (1, 4, "a"), (None, 5, "n")]),
    "orders": (
        "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_totalprice double",
        [(1, 1, DAY, 1.0), (2, 2, DAY, 2.0), (2, 1, DAY, 3.0), (3, None, DAY, 4.0), (None, 1, DAY, 5.0), (4, 1, None, 6.0)],
    ),
    "lineitem": (
        "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp_ntz",
        [(k, n, s, 1.0, 2.0, 0.1, 0.0, "A", DAY) for k in (1, 2, 3, None) for n, s in ((1, 1), (2, 2), (2, None), (3, 1))],
    ),
}


@pytest.fixture
def small(spark, tmp_path):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def counted(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("broadcast", [0, 1_000])
def test_large_sides_are_joined_without_a_sort(spark, small, monkeypatch, broadcast):
    expected = counted(views.trips(spark, small))
    assert sum(expected.values()) == 4 + 12
    monkeypatch.setattr(views, "PLAIN_ROWS", 0)
    monkeypatch.setattr(views, "BROADCAST_ROWS", broadcast)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = views.trips(spark, small)
        text = plan(found)
        assert "SortMergeJoin" not in text
        assert text.count("ShuffledHashJoin") == (1 if broadcast else 3)
        assert counted(found) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_are_moved_to_months_before_they_widen(spark, small, layout, monkeypatch):
    seen, real = [], layers.replace_all_months
    monkeypatch.setattr(layers, "replace_all_months", lambda df, root: seen.append(plan(df)) or real(df, root))
    layers.write_silver(spark, small, layout)
    above, below = seen[0].split("REBALANCE", 1)
    assert "Airport_fee" in above and "Airport_fee" not in below
    silver = read_table(spark, layout.silver_facts)
    assert silver.columns[-4:] == ["ingestion_timestamp", "source_file_name", "year", "month"]
    assert counted(silver.select(views.trips(spark, small).columns)) == counted(views.trips(spark, small))
    assert silver.where("year = 1996 AND month = 3").count() == silver.count()


def test_folder_names_are_those_of_the_format(spark):
    values = [None, -5, 0, 1, 9, 10, 12, 99, 100, 999, 1000, 1996, 9999, 10000]
    df = spark.createDataFrame([(v,) for v in values], "n int")
    for digits in (2, 4):
        named = df.select(tables.padded("n", digits).alias("quick"), F.format_string(f"%0{digits}d", "n").alias("slow"))
        assert all(r["quick"] == r["slow"] for r in named.collect())


def test_ordinary_months_are_not_formatted(spark, tmp_path, monkeypatch):
    """A format that fails on every row shows that no row of an ordinary month gets to it."""
    monkeypatch.setattr(tables.F, "format_string", lambda *_: F.raise_error(F.lit("formatted")).cast("string"))
    df = spark.range(24).selectExpr("id", "cast(1990 + id AS int) AS year", "cast(1 + id % 12 AS int) AS month")
    tables.replace_all_months(df, str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == 24
