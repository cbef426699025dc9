"""Connected components of an edge table, by alternating large and small stars.

Each round is two joins of the edges with one minimum a node; the edges of a round are
checkpointed, so that neither the plan nor the work after a lost executor grows with the
rounds.  Nothing but the number of changed edges reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the larger (large star) or smaller (small star) neighbours of each node to its least neighbour."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = both.join(least, "u")
    if large:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): for every node of the edges (u, v) the least node it is connected with."""
    now = checkpointed(edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not mark["n"] or (mark["n"], mark["h"]) == state:
            break
        state = (mark["n"], mark["h"])
        now = checkpointed(_star(_star(now, large=True), large=False))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
