"""Connected components of links, by alternating large and small stars.

Each round points every node at the smallest node it knows, once for the larger and once for the
smaller neighbours, until the links form stars. All rounds are joins and aggregates; the smallest
neighbour is found with a map-side aggregate, and a node with very many links is a skewed join key
that adaptive execution splits. No star has more links than it was made of, so the number of a
round's links bounds the tasks and files that the next one is worth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.scratch import remove_scratch, scratch_path, settle

# Links that one task of a round writes, if there are that many.
LINKS_A_TASK = 1 << 18


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every link has ``a > b``, and so has every result."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def _state(links: DataFrame) -> tuple:
    # A decimal sum cannot overflow.
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(links.agg(F.count(F.lit(1)), mark).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for each node that is no root.

    ``links`` has two columns of integers, ``a`` and ``b``; loops and repeats do no harm.
    """
    spark = links.sparkSession
    links = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    path = scratch_path(spark)
    links = settle(links.distinct(), path)
    before = _state(links)
    while before[0]:
        middle, last = scratch_path(spark), scratch_path(spark)
        # Narrow: more tasks than there are shuffle partitions are never made of it.
        tasks = -(-before[0] // LINKS_A_TASK)
        large = settle(_large_star(links).coalesce(tasks), middle)
        links = settle(_small_star(large).coalesce(tasks), last)
        # A round's tables are read by the next one only.
        remove_scratch(spark, path)
        remove_scratch(spark, middle)
        path = last
        after = _state(links)
        if after == before:
            break
        before = after
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
