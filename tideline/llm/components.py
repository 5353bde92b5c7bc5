"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (two long columns); the root is the least node reachable.

    Each round hooks every node's larger neighbours, then its smaller ones, to the least of them. Groups are only
    ever reduced to a minimum (combined before the shuffle), never gathered; rounds grow with the logarithm of the
    longest chain. Every round is written to the shared folder, so a lost executor costs one round at most.
    Links with a null end, self links and repeated links have no effect.
    """
    a, b = links.columns[:2]
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = written(edges.where("u <> v").distinct(), "links")
    state = None
    while True:
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        smaller = smaller.unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(smaller.where("u <> v").distinct(), "links")
