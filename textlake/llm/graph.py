"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlake.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest one."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("of"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("of")).filter("v > u").select(
        F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of these."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("of"), "m")
    tied = down.join(least, F.col("u") == F.col("of")).select(F.col("v").alias("u"), "m")
    return tied.union(least.select(F.col("of").alias("u"), "m")).filter("u <> m").select(
        "u", F.col("m").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for nodes with edges ``(u, v)``; the component is its smallest node.

    Alternates large-star and small-star until nothing changes, which takes about as many rounds
    as the logarithm of the longest chain. Each round is written to the shared folder. Loops and
    null ends are dropped.
    """
    edges = stored(edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v") % (1 << 40)).alias("h")).first()
        if state == before:
            break
        before = state
        edges = stored(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
