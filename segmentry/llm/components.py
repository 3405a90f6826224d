"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.session import cut


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """`node`, `root`: the smallest node that each linked node can reach. Nodes are of one orderable type.

    Alternates large stars and small stars until nothing changes, O(log² n) rounds. Links are distinct pairs after
    every step, so their number never grows beyond the input; a hub with many links is split by adaptive joins.
    NULL ends and links of a node with itself are left out; repeated links count once; no links give no rows.
    """
    pair = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = links.select(F.col(left).alias("a"), F.col(right).alias("b")).dropna().filter("a <> b")
    edges = cut(edges.select(pair.alias("p")).select("p.*").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("p")
        )
        edges = cut(small.select("p.*").filter("a <> b").distinct())
        after = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == after:
            break
        state = after
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
