"""Connected components of an edge table, with nothing collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (the smallest node reachable) for each node of ``edges`` (two columns).

    Alternates two rewirings until nothing changes: every node hands its larger neighbours to the smallest node
    that it sees (large star), then its smaller ones (small star). The edges never grow in number and end as
    one star per component; rounds grow with the logarithm of the longest path.
    """
    a, b = edges.columns
    e = saved(_oriented(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _oriented(
            both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(lowest, "u")
        small = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            lowest.select("u", F.col("m").alias("v"))
        )
        e = saved(_oriented(small), "edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def _oriented(edges: DataFrame) -> DataFrame:
    """Larger node first, no loops, no repeats."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    """How many edges there are, and a sum over them that any change moves."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
