"""Do two runs give the same rows?"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with ``surplus`` > 0 for the left.

    One shuffle; equal rows of a task cancel out before it.
    """
    columns = left.columns
    sides = left.withColumn("surplus", F.lit(1)).unionByName(right.withColumn("surplus", F.lit(-1)))
    return (
        sides.groupBy(*columns).agg(F.sum("surplus").alias("surplus")).filter(F.col("surplus") != 0)
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    return difference(left, right).isEmpty()


def fingerprint(df: DataFrame) -> DataFrame:
    """Row count and two order-free hashes: a cheap comparison without a shuffle of rows.

    Equal rows give equal fingerprints; :func:`difference` is the proof.
    """
    row_hash = F.xxhash64(*df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_hash.cast("decimal(19,0)")).alias("hash_sum"),
        F.bit_xor(F.xxhash64(F.lit(1), *df.columns)).alias("hash_xor"),
    )
