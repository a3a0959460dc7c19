"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripspark.llm import runtime


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (a, b): the component is
    its smallest node. Alternates the two star contractions until the edges
    no longer change; each pass is aggregated before it is joined, so a hub
    costs one row per task, and is written to the shared folder."""
    pairs = edges.select("a", "b").where("a <> b").distinct()
    # orient: b is the smaller end
    now = runtime.stored(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        after = runtime.stored(small, "edges")
        state = after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == tuple(state):
            break
        before, now = tuple(state), after
    return after.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        after.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
