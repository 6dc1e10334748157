"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketseries.session import cut_lineage


def _stars(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the least of the node's neighbours and itself, then the smaller ones."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.filter("a <> b").distinct()
    down = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(down, "a").select(F.col("b").alias("v"), "a", "m")
    return (
        small.select(F.col("v").alias("a"), F.col("m").alias("b"))
        .unionByName(small.select("a", F.col("m").alias("b")))
        .filter("a <> b").distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every id that occurs in ``edges`` (a, b) and isn't its own root; root is the least id reachable.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest chain. Nulls and
    loops are ignored, repeated edges count once.
    """
    now = edges.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = cut_lineage(now, "edges")
    state = None
    while True:
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == state or new[0] == 0:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root"))
        state = new
        now = cut_lineage(_stars(now), "edges")
