"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of links (a, b long): component is the smallest node reachable.

    Alternating stars: first every node links its larger neighbours to the smallest node around it, then its smaller
    ones and itself; rounds end when only stars are left. Minima are combined before rows move, and the joins with
    them are plain ones, whose skewed keys Spark splits. Null ends are not allowed; loops and repeated links do no harm.
    """
    loops = links.where("a = b").select(F.col("a").alias("node"), F.col("b").alias("component"))
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while True:
        both = edges.union(edges.select("b", "a"))
        around = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(around, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = cut(small.select("e.a", "e.b").where("a <> b").distinct())
        ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
        if ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty():
            stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b")).union(loops)
            return stars.groupBy("node").agg(F.min("component").alias("component"))
