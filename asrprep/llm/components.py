"""Connected components of a distributed edge table.

Alternating large-star and small-star steps (Kiveris et al., "Connected Components in MapReduce and
Beyond", 2014): every node hands its neighbours the smallest node it sees, until the edges are stars
around the smallest node of each component. Each step is a group minimum and a join, so no node's
neighbour list is ever gathered in one place; each round's edges are checkpointed in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asrprep.session import pin


def connected(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node of its component."""
    now = pin(edges.where(F.col(a) != F.col(b))
              .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(max_rounds):
        # large-star: a node's larger neighbours go to the smallest node it sees
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # small-star: a node and its smaller neighbours go to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                 .union(least.select("u", F.col("m").alias("v"))).distinct())
        now = pin(small)
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
        if before == tuple(seen):
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(seen)
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
