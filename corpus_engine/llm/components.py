"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.session import settled


def connected(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b`` long): root is the smallest node reachable.

    Each round hangs every node under the smallest neighbour it knows, first for the larger and
    then for the smaller neighbours, until the edges are stars. Rounds grow with the logarithm of
    the longest path. Minima are combined before the shuffle, so a hub costs one row per task; the
    joins back are plain equi-joins that adaptive execution splits. Every round is written to the
    shared folder, so a lost executor repeats one round at most. Loops and repeated edges are
    allowed; null ends are ignored. An empty edge table gives an empty result.
    """
    stars = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars = settled(stars, "stars")
    mark = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.unionByName(low.where("low < a").select("a", F.col("low").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(least, "a")
        small = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b"))
        )
        stars = settled(small.distinct(), "stars")
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    roots = stars.select(F.col("b").alias("a")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        roots.select(F.col("a").alias("node"), F.col("a").alias("root"))
    )
