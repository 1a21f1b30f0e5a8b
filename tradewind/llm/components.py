"""Connected components of links between ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stage


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Hang each vertex's neighbours (the smaller ones, or the larger ones) on its least."""
    hub = edges.groupBy("u").agg(F.min("v").alias("m"))
    if not small:
        hub = hub.withColumn("m", F.least("u", "m"))
    moved = edges.join(hub, "u")
    if small:
        down = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return down.unionByName(hub.select("u", F.col("m").alias("v")))
    return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in ``links``, component being the least id reachable.

    Nulls and self links are ignored. Each round is written below the checkpoint folder and
    the one before is deleted; the number of rounds grows with the logarithm of the longest
    path. Minima are combined before the shuffle, and the join on a busy vertex is one that
    adaptive execution can split.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, small=False).distinct()
        following = stage(_star(large, small=True).distinct())
        discard(edges)
        edges = following
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        roots.select(F.col("v").alias("id"), F.col("v").alias("component"))
    )
