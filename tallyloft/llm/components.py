"""Connected components by alternating stars: two joins and two aggregates a round, each round written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloft.session import stage


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """``node``, ``root`` for each node of ``links`` (a, b: bigint) that is not the smallest of its component.

    Rounds grow with the logarithm of the longest chain of links. A hub's links are summed up by partial aggregation, and the joins
    that hand its minimum back are split by adaptive execution where they are skewed.
    """
    stars = stage(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before = None
    while (now := _state(stars)) != before:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        nearest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(nearest, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("l"))
        stars, before = stage(small.select("l.a", "l.b").filter("a <> b").distinct(), label), now
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
