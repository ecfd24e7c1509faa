"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import cut, drop


def _stored(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Edges as a table, and their number and a sum of hashes, taken while it is written."""
    seen = Observation()
    hashes = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    stored = cut(edges.observe(seen, F.count(F.lit(1)).alias("n"), hashes.alias("h")), "edges")
    return stored, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached, for every node of an edge.

    Each step moves edges to smaller neighbours; a hub's neighbours are never gathered, minima are
    combined before the shuffle and joined back. Every step is written to the shared folder.
    """
    edges, before = _stored(edges.where(F.col("a") != F.col("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    while True:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND m < v").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b")
        small = small.select(F.col("m").alias("a"), "b").union(small.where("m < a").select(F.col("m").alias("a"), F.col("a").alias("b")))
        last = edges
        edges, after = _stored(small.distinct())
        drop(last)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).union(roots.select("node", F.col("node").alias("component")))
