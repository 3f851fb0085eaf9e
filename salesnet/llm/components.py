"""Connected components of an edge table, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesnet.llm.common import checkpointed

MAX_ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge.

    Alternating large-star / small-star rounds: each round points every node at
    the smallest neighbour it sees.  A round is two MIN aggregates (partial before
    the shuffle, so a node with a third of the edges is one row per task) and two
    equi-joins with one row per node on one side; rounds grow with the logarithm of
    the longest path.  Every round is checkpointed, so a lost executor costs one
    round; only a row count and a checksum reach the driver.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter(F.col("u") != F.col("v")).distinct())
    e = checkpointed(e)
    seen = _state(e)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        # large star: every neighbour above a node goes to the smallest around that node
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select(
            F.col("u").alias("c"), F.least("u", "v").alias("m"))
        large = (both.join(low, F.col("u") == F.col("c")).filter(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # small star: a node and its smaller neighbours go to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        small = (large.join(low, F.col("u") == F.col("c"))
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("s"))
                 .select("s.u", "s.v").filter(F.col("u") != F.col("v")).distinct())
        e = checkpointed(small)
        now = _state(e)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not converge")
    stars = e.groupBy("u").agg(F.min("v").alias("m"))
    roots = e.select(F.col("v").alias("u"), F.col("v").alias("m")).distinct()
    return (stars.union(roots).groupBy(F.col("u").alias("node")).agg(F.min("m").alias("component")))
