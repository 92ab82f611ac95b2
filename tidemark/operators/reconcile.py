"""Two tables compared by checksums, of which only differing parts are compared row by row.

Rows are dealt to buckets by a hash of all their columns. A bucket's checksum does not depend on the
order of its rows: their number and the sums of two hashes. Both sides are reduced to one row per
bucket, with a map-side aggregate; then only rows of buckets whose checksums differ are shuffled and
compared exactly. Equal tables shuffle no row at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.copies import COPIES
from tidemark.operators.names import aside

BUCKETS = 1 << 14
SIDE = "side"


def _bucket(columns: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns]), F.lit(buckets)).cast("int")


def bucket_checksums(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row per bucket: number of rows and the sums of two hashes of them."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    # Hashes of the same columns with and without a leading constant have nothing in common.
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns)
    hashed = df.select(_bucket(df.columns, buckets).alias("_bucket"), first.alias("_h"), second.alias("_g"))
    exact = "decimal(38,0)"
    return hashed.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.col("_h").cast(exact)).alias("_sum_h"),
        F.sum(F.col("_g").cast(exact)).alias("_sum_g"),
    )


def differing_buckets(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The buckets whose checksums differ; at most ``buckets`` rows."""
    one = bucket_checksums(left, buckets)
    other = bucket_checksums(right, buckets).withColumnsRenamed({c: f"{c}2" for c in ("_n", "_sum_h", "_sum_g")})
    same = F.lit(True)
    for name in ("_n", "_sum_h", "_sum_g"):
        same = same & F.col(name).eqNullSafe(F.col(f"{name}2"))
    return one.join(other, "_bucket", "full").where(~same).select("_bucket")


@aside
def reconcile(left: DataFrame, right: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Rows that one side has more often than the other, with the ``side`` that has them and the number
    of ``copies`` it has more. Columns are compared by position; NULLs, NaNs and zeros compare equal.

    The list of differing buckets is broadcast: it has at most ``buckets`` numbers.
    """
    right = right.toDF(*left.columns)
    wanted = F.broadcast(differing_buckets(left, right, buckets))

    def suspects(df: DataFrame, sign: int) -> DataFrame:
        dealt = df.withColumn("_bucket", _bucket(df.columns, buckets))
        return dealt.join(wanted, "_bucket", "left_semi").drop("_bucket").withColumn("_sign", F.lit(sign))

    columns = [F.col(f"`{c}`") for c in left.columns]
    both = suspects(left, 1).unionAll(suspects(right, -1))
    counted = both.groupBy(*columns).agg(F.sum("_sign").alias(COPIES)).where(F.col(COPIES) != 0)
    side = F.when(F.col(COPIES) > 0, "left").otherwise("right")
    return counted.select(side.alias(SIDE), F.abs(COPIES).alias("copies"), *columns)
