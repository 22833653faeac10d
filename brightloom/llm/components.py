"""Connected components of a graph given as a table of edges, by alternating stars.

Each round links every node's larger neighbours, and then its smaller ones, to the smallest node it
knows; rounds are written to the shared folder and end when nothing changes. Minima are combined
before the shuffle, and no node's neighbours are ever gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightloom.workspace import discard, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("_m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("_m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.union(least.select("u", F.col("_m").alias("v"))).where("u <> v").distinct()


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40)), F.sum(F.xxhash64("v", "u") % (1 << 40))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node, component``: for each node with an edge the smallest node it can reach."""
    now = written(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        last, now = now, written(_small_star(_large_star(now)), "stars")
        discard(last)
        signature = _signature(now)
        if signature == before:
            break
        before = signature
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    # every edge now leads from a node to the smallest of its component
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
