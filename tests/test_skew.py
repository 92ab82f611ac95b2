"""Hot keys where a lookup is too large to broadcast."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookups

ROWS, ZONES = 1_200_000, 4_000
CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
}


@pytest.fixture
def shuffled(spark, monkeypatch):
    """No broadcasts, and thresholds that make a small test skewed."""
    monkeypatch.setattr(lookups, "BROADCAST_BYTES", 0)
    for name, value in CONF.items():
        spark.conf.set(name, value)
    yield spark
    for name in CONF:
        spark.conf.unset(name)


@pytest.fixture
def facts(spark, tmp_path):
    """Half of the facts have one pickup location."""
    hot = F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % (ZONES + 100)).cast("int")
    df = spark.range(0, ROWS, 1, 8).select(
        hot.alias("PULocationID"), F.xxhash64("id").alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b"))
    df.write.parquet(str(tmp_path / "facts"))
    return spark.read.parquet(str(tmp_path / "facts"))


def zones(spark):
    return lookups.check_lookup(spark.range(ZONES).selectExpr(
        "CAST(id AS int) AS LocationID", "'B' AS Borough", "concat('Z', id) AS Zone", "'s' AS service_zone"))


@pytest.mark.parametrize("operator", [
    lambda facts, zones: lookups.enrich(facts, zones, {"PULocationID": "PU"}),
    lambda facts, zones: lookups.flag_known(facts, "PULocationID", zones, "known"),
    lambda facts, zones: lookups.matched(facts, "PULocationID", zones),
    lambda facts, zones: lookups.orphans(facts, "PULocationID", zones),
])
def test_hot_key_is_split_over_tasks(shuffled, facts, operator):
    df = operator(facts, zones(shuffled))
    tasks = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    hot = ROWS // 2
    assert sum(tasks) in (ROWS, df.count())
    assert max(tasks) < hot / 2


def test_counts_are_right(shuffled, facts):
    known = lookups.matched(facts, "PULocationID", zones(shuffled)).count()
    lost = lookups.orphans(facts, "PULocationID", zones(shuffled)).count()
    assert known + lost == ROWS
    assert lost == facts.where(F.col("PULocationID") >= ZONES).count()
