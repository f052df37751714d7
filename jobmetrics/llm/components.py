"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from jobmetrics.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is connected with the node's least neighbour, or the node."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are connected with the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges``, columns u and v; component is the least node.

    Both steps group by node with partial aggregation, and a node with very many neighbours is
    split by adaptive joins. Each round is written to the shared folder, which cuts the lineage;
    two numbers of it reach the driver, which stops when a round changes nothing. Edges with a
    null end and loops connect nothing; a node with loops alone is not in the result.
    """
    now = stored(edges.where("u <> v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        summary = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if summary == state or not summary["n"]:
            break
        state = summary
        now = stored(small_star(large_star(now).distinct()).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
