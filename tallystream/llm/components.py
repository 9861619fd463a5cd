"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystream.session import settle


def _print(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row.n, int(row.s or 0)


def _star(around: DataFrame) -> DataFrame:
    """Neighbours of every node joined with the smallest of them and the node itself."""
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    return around.join(least, "u").withColumn("m", F.least("u", "m"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest node of each node's component, from edges (u, v): columns node, root.

    Large-star and small-star steps in turn, until nothing changes: each keeps the components and
    hangs nodes nearer to their smallest; the number of edges never grows. Every round is
    checkpointed. Loops and repeated edges do no harm; nodes without edges don't appear.
    """
    edges = settle(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _print(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Every u is larger than its v here, so v are exactly the smaller neighbours.
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))
        )
        edges = settle(small.where("u <> v").distinct())
        now = _print(edges)
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
