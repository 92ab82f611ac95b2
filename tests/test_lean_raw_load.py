"""Rejects are judged without arrays and file names gathered by hash; the rows are the same."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from test_physical_plans import plan
from tidemark.operators import rules
from tidemark.plans import raw as raw_plan
from tidemark.sources.facts import read_month_file
from trips import KEY, frame, trip


def counted(df):
    return Counter(map(tuple, df.collect()))


def test_rejects_are_judged_without_arrays(spark):
    rows = [(None, 5), (0, 5), (1, None), (1, 500), (1, 5), (None, None)]
    df = spark.createDataFrame(rows, "a int, b int")
    judged = [rules.null_rule("null", df.select("a").schema), rules.zero_rule("zero", "a"), rules.range_rule("range", ["b"], 1, 9)]
    found = rules.rejected_once(df, judged)
    assert found.columns == ["a", "b", "rule"]
    assert counted(found) == counted(rules.rejected(rules.classify(df, judged)))
    assert "Generate" not in plan(found)
    with pytest.raises(ValueError, match="rule"):
        rules.rejected_once(df.withColumn("rule", F.lit(1)), judged)


def test_names_of_files_are_gathered_by_hash(spark, layout, monkeypatch, tmp_path):
    path = layout.landing_file(KEY)
    frame(spark, [trip(n % 4) for n in range(12)]).repartition(3).write.parquet(path)
    plans, real = {}, raw_plan.settle
    monkeypatch.setattr(raw_plan, "settle", lambda df, to: plans.update({to.rsplit("/", 1)[1]: plan(df)}) or real(df, to))
    landing = read_month_file(spark, path, KEY)
    found = raw_plan.find_copies(landing, str(tmp_path / "stage"))
    text = plans["files"]
    assert text[text.rindex("Aggregate(") - 4:].startswith("HashAggregate(")
    assert found.groups.count() == 4 and found.repeated() == 8
    names = landing.select("_metadata.file_name").distinct()
    assert found.groups.join(names, F.col("_source_file") == F.col("file_name"), "left_semi").count() == 4
