"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectio.llm.common import forget, stored


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, component): the least node reachable. Nodes without a link are left out; loops are ignored.

    Every round is a sum by key and a join; each is written to the shared folder, which also cuts the lineage.
    """
    pairs = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stored(pairs, "links")
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # every edge now points from a node to a smaller one
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, pairs = pairs, stored(small.unionByName(least.select("u", F.col("m").alias("v"))).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "links")
        forget(old)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        before = now
