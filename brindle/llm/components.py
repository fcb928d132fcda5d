"""Connected components of links by alternating stars, round by round as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brindle.llm.common import discard, written


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour (or the node itself)."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them. Links point from larger to smaller."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root (the smallest node of its component) for every node of the links; null ends and loops are ignored.

    Alternating large and small stars keep at most as many links as there were and end when every node points to its
    root. Smallest neighbours are found by pre-aggregated minima; joins on a node with very many links are left to the
    skew handling of adaptive execution. Each round is written to the shared folder.
    """
    now = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"), F.col(a).alias("x"), F.col(b).alias("y")).filter("x is not null and y is not null and x <> y").select("a", "b").distinct()
    now = written(now, "links")
    state = None
    while True:  # a logarithmic number of rounds
        before, now = now, written(_small_star(_large_star(now)), "links")
        discard(before)
        row = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == (row["n"], row["h"]):
            break
        state = (row["n"], row["h"])
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
