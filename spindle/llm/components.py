"""Connected components of a distributed edge list by alternating stars.

Each round hooks every node's neighbours to the smallest label around it, first
the larger neighbours, then the smaller ones; labels halve their distance to the
component's smallest node, so the rounds grow with the logarithm of the longest
path.  Only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm._common import checkpointed


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    hooked = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hooked.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root`` of every node in ``edges(a, b)``, two columns of one ordered
    type; the root is the smallest node of the component and has a row itself.
    Loops and repeated edges do no harm; no edges give no rows."""
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = checkpointed(edges), None
    for _ in range(rounds):
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before or not now["n"]:
            break
        before = now
        edges = checkpointed(_small_star(_large_star(edges)))
    else:
        raise RuntimeError(f"no end after {rounds} rounds")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
