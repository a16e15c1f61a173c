"""Connected components of a large graph of links by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from longform.sources.storage import settle


def _lowest(edges: DataFrame) -> DataFrame:
    """u and the smallest of its neighbours; combined before the shuffle, so a hub costs one row per task."""
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def large_star(edges: DataFrame) -> DataFrame:
    """Each node sends its larger neighbours to the smallest node it knows."""
    each = _both(edges)
    low = _lowest(each).select("u", F.least("u", "low").alias("low"))
    return each.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node sends itself and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v")
    low = _lowest(down)
    moved = down.join(low, "u").where("v > low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links between longs to (node, root): the smallest node of its component, for all nodes but the roots.

    Each step is written to the shared folder, which cuts its lineage; the steps grow with the
    logarithm of the longest path.
    """
    checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    at = settle(edges.where("u <> v").select("u", "v"), "links", n=F.count("*"), sum=checksum)
    while at.metrics["n"]:
        after = settle(small_star(large_star(at.df)), "links", n=F.count("*"), sum=checksum)
        if after.metrics == at.metrics:
            break
        at = after
    return at.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
