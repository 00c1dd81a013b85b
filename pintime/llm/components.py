"""Connected components of a links table, by alternating large and small stars.

Each star is an aggregation (the least neighbour of every node, combined in the
tasks first) and a join with it, so no node's neighbours are ever gathered; a hub
with very many links is only a skewed join, which Spark splits. Rounds are written
to the shared folder, which cuts lineage; the number of rounds grows with the
logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pintime.session import scratch_dir


def written(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The frame, written once to the shared folder and read back from there."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, component) for every node of ``links(a, b)`` but the least of each component.

    The component is its least node. Loops, nulls and repeated links are ignored.
    """
    spark: SparkSession = links.sparkSession
    folder = folder or scratch_dir(spark, "components")
    edges = (links.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                          F.least("a", "b").alias("b")).distinct())
    edges = written(edges, folder, "links-0")
    before, turn = None, 0
    while True:
        after = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after[0] == 0 or after == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before, turn = after, turn + 1
        edges = written(_small_star(_large_star(edges)), folder, f"links-{turn}")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the node's least neighbour (or itself)."""
    both = edges.union(edges.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(
        "a", F.least("a", "least").alias("least"))
    # (a, b) with b > a of ``both`` are the links themselves, turned
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("far"))
    return turned.join(least, "a").select(F.col("far").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, go to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").where("b <> least").select(
        F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.toDF("a", "b")).distinct()
