"""Connected components of an edge list, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import staged


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node its smallest neighbour or itself: a minimum, so a hub costs one row per task."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(``id``, ``component``) for every node of ``edges`` (``a``, ``b``): the smallest id reachable.

    Each step moves every neighbour of a node to the smallest one it knows; the steps end, after
    about log(n) rounds, in stars around the smallest nodes. Steps join on a node, which may be a
    hub; both sides are shuffled, so adaptive execution can split it.
    """
    now = staged(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_smallest(both), "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        small = _smallest(large)
        now = staged(
            large.join(small, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u != v")
            .distinct(),
            "edges",
        )
        size = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == size:
            break
        seen = size
    member = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return member.unionByName(member.select(F.col("component").alias("id"), "component").distinct())
