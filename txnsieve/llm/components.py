"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnsieve.session import staged


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hangs the neighbours of each node on the smallest of them; small: only the smaller neighbours."""
    back = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    around = edges if small else staged(edges.unionByName(back), "star-both")  # edges run from larger to smaller ids
    least = staged(around.groupBy("u").agg(F.min("v").alias("m")), "star-least")
    joined = around.join(least, "u").withColumn("m", F.least("m", "u"))
    if small:
        moved = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
    return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def connected(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label``, the smallest node of its component, for every node of some pair of two nodes.

    Pairs may repeat and run in either direction; pairs with a null or of a node with itself count
    for nothing. The rounds grow with the logarithm of the longest chain; each is written to the
    shared folder, so a lost executor costs one round at most.
    """
    pairs = pairs.where(f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} != {b}")
    edges = staged(pairs.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()
        if state == seen or state["n"] == 0:
            break
        seen = state
        edges = staged(_star(staged(_star(edges, False), "large-star"), True), "small-star")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)
