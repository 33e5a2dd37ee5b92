"""Connected components of an edge table: alternating large and small stars, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelake.llm.common import discard, stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is tied to the least of the node and its neighbours."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are tied to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    ties = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return ties.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of the edges ``u``, ``v``; the component is its least node.

    Every round at least halves the height of the trees; rounds end when the edges,
    compared by count and sums of hashes, stay as they are.  Each round is a written table and
    deletes the one before.
    Loops (u = v) and repeated edges change nothing; an edge with a null end is left out.
    """
    loops = edges.where("u = v").select(F.col("u").alias("node"))
    stars, path = stored(edges.where("u <> v").select("u", "v").distinct(), "edges")
    before = None
    while True:
        shape = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")),
        ).first()
        if shape[0] == 0 or shape == before:
            break
        before = shape
        old = path
        stars, path = stored(_small_star(_large_star(stars)), "edges")
        discard(edges.sparkSession, old)
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
    return found.union(loops.distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
