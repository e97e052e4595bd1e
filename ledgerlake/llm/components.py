"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stored


def _state(edges: DataFrame):
    """Two numbers that tell whether an edge set has changed."""
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b, longs, a != b);
    comp is the smallest node reachable.

    Large-star links a node's larger neighbours to its smallest one,
    small-star its smaller ones; both keep the components and shorten paths,
    so the rounds grow with the logarithm of a component's size. Every round
    is written to the shared folder; only two numbers reach the driver."""
    e = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while (now := _state(e)) != before:
        before = now
        if now[0] == 0:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = pairs.unionByName(low.select("u", F.col("m").alias("v"))).filter("u != v")
        small = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        e = stored(small, "edges")
    members = e.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    return members.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("comp"))).groupBy("node").agg(
        F.min("comp").alias("comp"))
