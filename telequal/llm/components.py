"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is joins and minima over the links; none gathers a node's neighbours.  State is a written table after
each round, so a lost executor costs one round at most and plans stay short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telequal.session import durable


def _state(links: DataFrame) -> tuple[DataFrame, tuple]:
    kept = durable(links)
    r = kept.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return kept, tuple(r)


def components(links: DataFrame) -> DataFrame:
    """Smallest reachable node (``root``) of every ``node`` in links ``a``-``b``; loops and repeats are ignored."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links, seen = _state(links)
    while seen[0]:
        # Large star: every larger neighbour of a node moves to the node's smallest neighbour.
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(low.select("a", F.col("m").alias("b")))
            .distinct()
        )
        links, now = _state(small)
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
