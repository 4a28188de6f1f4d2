"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barspark.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b`` (bigint); the root is the smallest node reachable.

    Each round is two joins on the edge table; edges only ever point to smaller nodes, and the rounds
    end when a whole round changes nothing (about log(nodes) rounds).  Every round is a written table,
    so a lost executor re-reads it.  Two counters come to the driver, never edges.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    before = None
    while True:
        # Large star: every neighbour above u points to the smallest of u's neighbourhood.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: u and its smaller neighbours point to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
        now = materialize(small.select(F.col("e.v").alias("u"), F.col("e.m").alias("v")).filter("u <> v").distinct(), "star")
        # Same edges twice in a row: settled.  The sum of hashes is an order-free digest of the table.
        digest = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if digest == before:
            break
        before = digest
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
