"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawscan.llm.common import dropped, hot_keys, replicated, salted, stored_at


def _told(pairs: DataFrame, least: DataFrame) -> DataFrame:
    """pairs (u, v) with the m of their u; the centre of a large star is dealt by salt."""
    hot = hot_keys(pairs.select("u"), "u")
    return salted(pairs, hot, "u", F.xxhash64("v")).join(replicated(least, hot, "u"), ["u", "_salt"]).select("u", "v", "m")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: for each node of a link the smallest node that it reaches.

    Large-star hangs a node's larger neighbours on its smallest neighbour, small-star the others; both keep what is
    reachable and halve depths, so a logarithmic number of rounds ends in stars. Each round is a written table; counts
    and sums tell when nothing changes. No node's neighbours are gathered: each step is an aggregate and a join in which
    the centres of large stars are salted.
    """
    spark = links.sparkSession
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs, path = stored_at(pairs, "links")
    seen = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = _told(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large, large_path = stored_at(large, "large-star")
        below = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _told(large, below).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        dropped(spark, path)
        pairs, path = stored_at(small.where("u <> v").distinct(), "small-star")
        dropped(spark, large_path)
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        seen = now
