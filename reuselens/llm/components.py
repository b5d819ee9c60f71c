"""Connected components of a table of links, by alternating stars.

Each round points every node to the smallest node around it (large star, then
small star) and writes the links; rounds go on until the links are stars (each
node has one link, to a node without), and links that are not after
``MAX_ROUNDS`` are an error.  The links never leave Spark, and the small star
bounds what a node gathers: a node's links become one link to its smallest
neighbour for each neighbour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reuselens.llm.common import materialise

MAX_ROUNDS = 60


def _star(both: DataFrame, large: bool) -> DataFrame:
    """``both``: links ``u, v``. The neighbours of u (the larger ones, or the
    smaller ones and u itself) link to the smallest of u and its neighbours."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.where(F.col("u") != F.col("m")).select("u", F.col("m").alias("v"))
    return joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")) \
        .unionByName(own)


def _settled(rows: DataFrame) -> bool:
    """Whether each ``u`` has one link, to a node that is no ``u``. Links always
    point to the smaller node, so these are the components."""
    ends = rows.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(rows.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node that can be reached) of every
    node of ``links`` (``a, b``; nodes are numbers, null links and links of a
    node with itself are ignored)."""
    rows = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    rows = materialise(rows)
    for _ in range(MAX_ROUNDS):
        if _settled(rows):
            break
        mirrored = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        after = _star(mirrored, large=True).where("u != v")
        after = _star(after, large=False).where("u != v").distinct()
        rows = materialise(after)
    else:
        raise RuntimeError(f"links still changed after {MAX_ROUNDS} rounds")
    return rows.select(F.col("u").alias("node"), F.col("v").alias("component")) \
        .unionByName(rows.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
