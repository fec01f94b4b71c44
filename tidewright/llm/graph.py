"""Connected components over an edge table, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewright.llm.common import written


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node of ``edges``; component is the smallest node reachable.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the edge set stays the
    same: O(log^2 n) rounds, each two joins on a node. Each round's edges are a table in
    the shared folder. Edges with a null end or from a node to itself link nothing; a node that occurs only so is not returned.
    """
    now = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).filter("u <> v").distinct()
    now = written(now, "cc")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = written(small.select(F.col("e.a").alias("u"), F.col("e.b").alias("v")).filter("u <> v").distinct(), "cc")
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == state:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
