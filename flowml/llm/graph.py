"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowml.session import drop_scratch, materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v), root being its component's smallest node.

    Alternating large-star and small-star steps: each links a node's neighbours to the
    smallest of them, until every node points at its root. A step is two aggregations and
    two joins over the edges left; edges are written to the shared folder after each, so a
    lost executor costs one step. Loops (u = v) give components of one node.
    """
    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))

    loops = edges.where("u = v").select(F.col("u").alias("node")).distinct()
    now = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                      .distinct(), "edges")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(least(both), "u") \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = least(large)
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        after = materialise(small, "edges")
        seen = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_scratch(now.sparkSession, now)
        now = after
        if seen == mark:
            break
        mark = seen
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    linked = now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    return linked.unionByName(loops.join(linked, "node", "left_anti").select("node", F.col("node").alias("root")))
