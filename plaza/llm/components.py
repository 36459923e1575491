"""Connected components of a graph given as edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, spread_join, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: (u, v) with u > v. large: every greater neighbour of a node goes to the least of its neighbourhood; small: every lesser one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n"))
    out = spread_join(both, least, ["u"], "v").where(F.col("v") > F.col("u") if large else F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = out.unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, label) of every node of ``edges(u, v)``; the label is the least node reachable.

    Edges may repeat, run either way or be loops; an empty table gives no rows. Each round
    is written to the shared folder; their number is logarithmic in the longest path. The edges
    of a node with many are dealt to several tasks.
    """
    now = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        last, now = now, stored(_star(_star(now, True), False), "edges")
        discard(last)
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
    else:
        raise RuntimeError(f"components don't settle in {most_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
