"""Months switch in one step, their columns are known without opening files, and the catalog follows."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.model import RunKey
from tidemark.plans import raw as raw_plan
from tidemark.plans.raw import RejectedShareError, load_raw
from tidemark.plans.report import LostRowsError
from tidemark.sinks import tables
from tidemark.sources import versions
from tidemark.sources.facts import read_partition, read_table, require_months
from tidemark.sources.listing import list_months
from tidemark.sources.versions import SchemaConflictError
from trips import KEY, frame, land, totals, trip

OTHER = RunKey(2024, 2)
FIRST = [trip(1), trip(1), trip(2, PULocationID=0)]
SECOND = [trip(5), trip(6, PULocationID=0), trip(7), trip(7)]


def state(spark, layout):
    rejects = tables.read_quarantine(spark, layout.quarantine, "raw")
    return (
        totals(read_partition(spark, layout.raw_facts, KEY)),
        sorted((r["rule"], r["total_amount"]) for r in rejects.collect()),
        totals(read_table(spark, layout.raw_facts)),
    )


BEFORE = ([1.0], [("dropped_duplicates", 1.0), ("dropped_locations", 2.0)], [1.0])
AFTER = ([5.0, 7.0], [("dropped_duplicates", 7.0), ("dropped_locations", 6.0)], [5.0, 7.0])


@pytest.mark.parametrize("step", ["write_version", "replace_quarantine", "write_rule", "report_load", "switch_month"])
def test_a_load_that_fails_between_writes_changes_nothing(spark, layout, monkeypatch, step):
    land(frame(spark, FIRST), layout)
    load_raw(spark, layout, KEY)
    assert state(spark, layout) == BEFORE
    land(frame(spark, SECOND), layout)
    real = getattr(raw_plan, step)

    def broken(*args, **named):
        if step not in ("report_load", "switch_month"):
            real(*args, **named)
        raise RuntimeError(step)

    with monkeypatch.context() as patch:
        patch.setattr(raw_plan, step, broken)
        with pytest.raises(RuntimeError, match=step):
            load_raw(spark, layout, KEY)
    assert state(spark, layout) == BEFORE
    load_raw(spark, layout, KEY)
    assert state(spark, layout) == AFTER


def test_lost_rows_are_found_before_the_switch(spark, layout, monkeypatch):
    land(frame(spark, FIRST), layout)
    load_raw(spark, layout, KEY)
    land(frame(spark, SECOND), layout)
    monkeypatch.setattr(raw_plan, "write_rule", lambda *_: None)
    with pytest.raises(LostRowsError):
        load_raw(spark, layout, KEY)
    assert state(spark, layout) == BEFORE


def test_a_month_with_too_many_rejects_is_refused(spark, layout):
    land(frame(spark, FIRST), layout)
    load_raw(spark, layout, KEY)
    land(frame(spark, SECOND), layout)
    with pytest.raises(RejectedShareError):
        load_raw(spark, layout, KEY, most_rejected=0.4)
    assert state(spark, layout) == BEFORE
    load_raw(spark, layout, KEY, most_rejected=0.5)
    assert state(spark, layout) == AFTER


def test_a_query_that_is_reading_keeps_its_files_over_one_switch(spark, tmp_path):
    root = str(tmp_path)
    tables.replace_month(spark.range(3), root, KEY)
    reading = read_partition(spark, root, KEY)
    tables.replace_month(spark.range(7), root, KEY)
    assert reading.count() == 3 and read_partition(spark, root, KEY).count() == 7
    tables.replace_month(spark.range(9), root, KEY)
    folders = sorted(p.name for p in (tmp_path / KEY.partition).iterdir())
    assert len(folders) == 2 and read_table(spark, root).count() == 9


def test_plain_months_are_read_beside_versions_and_replaced(spark, tmp_path):
    root = str(tmp_path)
    spark.range(2).write.parquet(f"{root}/{KEY.partition}")
    assert read_table(spark, root).count() == 2
    tables.replace_month(spark.range(3).selectExpr("id", "'n' AS more"), root, OTHER)
    both = read_table(spark, root)
    assert both.columns == ["id", "more", "year", "month"] and both.count() == 5
    tables.replace_month(spark.range(4), root, KEY)
    assert read_table(spark, root).count() == 7 and not list((tmp_path / KEY.partition).glob("*.parquet"))
    # A writer that knows nothing of versions replaces the folder as a whole.
    spark.range(1).write.mode("overwrite").parquet(f"{root}/{KEY.partition}")
    assert read_partition(spark, root, KEY).count() == 1 and read_table(spark, root).count() == 4


def dated(spark, *months):
    rows = [(key.year, key.month, n) for key in months for n in range(key.month)]
    return spark.createDataFrame(rows, "year int, month int, n int")


def test_a_refresh_of_the_whole_table_is_one_step(spark, tmp_path):
    root = str(tmp_path)
    third = RunKey(2024, 3)
    tables.replace_month(spark.range(9).selectExpr("int(id) AS n"), root, KEY)
    tables.replace_all_months(dated(spark, OTHER, third), root)
    assert {(r["month"], r["count"]) for r in read_table(spark, root).groupBy("month").count().collect()} == {(2, 2), (3, 3)}
    with pytest.raises(FileNotFoundError):
        read_partition(spark, root, KEY)
    assert not (tmp_path / KEY.partition).exists()
    tables.replace_month(spark.range(5).selectExpr("int(id) AS n"), root, OTHER)
    tables.replace_all_months(dated(spark, KEY, OTHER), root)
    assert {(r["month"], r["count"]) for r in read_table(spark, root).groupBy("month").count().collect()} == {(1, 1), (2, 2)}
    assert {r["month"] for r in list_months(spark, root).collect()} == {1, 2}
    tables.replace_all_months(dated(spark).limit(0), root)
    with pytest.raises(FileNotFoundError):
        read_table(spark, root)


def test_reading_a_table_merges_no_footers(spark, tmp_path):
    root = str(tmp_path)
    tables.replace_month(spark.range(3), root, KEY)
    tables.replace_month(spark.range(2).selectExpr("id", "'n' AS more"), root, OTHER)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ledger", "reading a table")
    table = read_table(spark, root)
    assert table.columns == ["id", "more", "year", "month"]
    assert list(tracker.getJobIdsForGroup("ledger")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert table.where("month = 1 AND more IS NULL").count() == 3


def test_months_are_pruned_by_their_folders(spark, tmp_path):
    root = str(tmp_path)
    for key in (KEY, OTHER):
        tables.replace_month(spark.range(3), root, key)
    plan = read_table(spark, root).where("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_columns_of_two_types_are_refused(spark, tmp_path):
    root = str(tmp_path)
    tables.replace_month(spark.range(3), root, KEY)
    tables.replace_month(spark.range(3).selectExpr("string(id) AS id"), root, OTHER)
    with pytest.raises(SchemaConflictError, match="id is bigint"):
        read_table(spark, root)


def test_absent_months_are_named(spark, tmp_path):
    tables.replace_month(spark.range(3), str(tmp_path), KEY)
    require_months(spark, str(tmp_path), [KEY])
    with pytest.raises(FileNotFoundError, match="2024-02, 2025-01"):
        require_months(spark, str(tmp_path), [KEY, OTHER, RunKey(2025, 1)])


@pytest.fixture
def statements(spark, monkeypatch):
    seen, real = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: (seen.append(text), real(self, text, *a, **k))[1])
    return seen


def test_publishing_touches_one_partition_and_never_drops_the_table(spark, tmp_path, statements):
    root, name = str(tmp_path), "trips_versions"
    for n, key in enumerate((KEY, OTHER, RunKey(2024, 3))):
        tables.replace_month(spark.range(n + 1), root, key)
    assert tables.publish_months(spark, name, root) == [KEY, OTHER, RunKey(2024, 3)]
    statements.clear()
    assert tables.publish_months(spark, name, root) == []
    assert not [s for s in statements if s.startswith("ALTER")]
    tables.replace_month(spark.range(8).selectExpr("id", "'n' AS more"), root, OTHER)
    assert spark.table(name).where("month = 2").count() == 2  # not published yet: still the earlier rows
    assert tables.publish_months(spark, name, root) == [OTHER]
    changes = [s for s in statements if "PARTITION (" in s]
    assert len(changes) == 1 and "month = 2" in changes[0] and "SET LOCATION" in changes[0]
    assert not [s for s in statements if "DROP TABLE" in s or "MSCK" in s]
    assert spark.table(name).where("more = 'n'").count() == 8
    assert spark.table(name).count() == 1 + 8 + 3
    versions.remove_month(spark, root, KEY)
    assert tables.publish_months(spark, name, root) == [KEY]
    assert spark.table(name).count() == 8 + 3
    spark.sql(f"DROP TABLE {name}")


def test_a_refreshed_table_moves_all_its_partitions(spark, tmp_path):
    root, name = str(tmp_path / "it's"), "trips_refreshed"
    tables.replace_all_months(dated(spark, KEY, OTHER), root)
    tables.publish_months(spark, name, root)
    tables.replace_all_months(dated(spark, OTHER, RunKey(2024, 3)).withColumn("n", F.col("n") + 10), root)
    assert tables.publish_months(spark, name, root) == [KEY, OTHER, RunKey(2024, 3)]
    assert sorted(r["n"] for r in spark.table(name).collect()) == [10, 10, 11, 11, 12]
    spark.sql(f"DROP TABLE {name}")


def test_an_unfinished_mark_is_not_seen(spark, tmp_path):
    root = str(tmp_path)
    tables.replace_month(spark.range(3), root, KEY)
    version = versions.new_version()
    tables.write_version(spark.range(9), root, KEY, version)
    Path(f"{root}/_versions/{KEY.partition}/.{version}.json.half").write_text("{")
    assert read_partition(spark, root, KEY).count() == 3
    versions.switch_month(spark, root, KEY, version, spark.range(9).schema)
    assert read_partition(spark, root, KEY).count() == 9
