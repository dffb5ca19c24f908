"""Connected components with DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.session import stored


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) of every node that a link touches; root is the component's smallest node.

    Alternates the large-star and small-star steps, so the number of rounds grows with the
    logarithm of the longest path. Minima are combined before each shuffle, so a hub with many
    links is no single task's work; each round's links are written to the shared folder.
    Links with a null end, loops and repeated links add nothing. No links: no rows.
    """
    a, b = F.col(left), F.col(right)
    edges = stored(links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(
        F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("v", "m"))
        # Large star: every larger neighbour of v moves to the least of v and its neighbours.
        large = (edges.withColumnRenamed("u", "w").withColumnRenamed("v", "x")
                 .join(least.withColumnRenamed("v", "w"), "w").select(F.col("x").alias("v"), F.col("m").alias("u"))).distinct()
        # Small star: v and its smaller neighbours move to the smallest of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v <> u")
        nxt = stored(small.unionByName(low.withColumnRenamed("m", "u")).where("v <> u").distinct())
        now = _state(nxt)
        edges, done, state = nxt, now == state, now
        if done:
            break
    roots = edges.select(F.col("u").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    """Number and order-free hash of the links: equal in two rounds once nothing moves."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
    return row[0], row[1]
