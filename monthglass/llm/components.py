"""Connected components of a link table, with the minimum id as label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage_table

#: A node with more than this share of all links, and at least so many, is a hub: there are at most twice as many as the share allows.
HUB_SHARE, HUB_LEAST = 10_000, 1_000


def connected(links: DataFrame, least_hub: int = HUB_LEAST) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``; root is the component's smallest node.

    Alternates two steps: each node hands its larger neighbours, then its smaller ones,
    to the smallest node it knows. A node's neighbours are never gathered in one row,
    only their minimum, which is added up before the shuffle. A hub's links take that
    minimum from a small table and don't meet in a task. It ends when the links
    are stars: each node hangs on one smaller node that itself hangs on none. Null ends
    and self links are ignored; no links give an empty table.
    """
    edges = stage_table(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    while True:
        hub = max(least_hub, edges.count() // HUB_SHARE)
        edges = stage_table(_towards_least(_towards_least(edges, True, hub), False, hub).distinct(), "links")
        if _all_stars(edges):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )


def _all_stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    seen = ends.groupBy("node").agg(F.sum("below").alias("below"), F.max("above").alias("above"))
    return seen.where((F.col("below") > 1) | ((F.col("below") > 0) & (F.col("above") > 0))).isEmpty()


def _towards_least(edges: DataFrame, larger: bool, hub: int) -> DataFrame:
    """Links (u, v), u > v, replaced by links to the least neighbour of u; u with more than `hub` links is a hub."""
    sides = edges.select("u", "v")
    if larger:
        sides = sides.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    # Few rows: every hub has its own share of all links.
    hubs = least.where(F.col("n") > hub).select("u", F.col("m").alias("at_hub"))
    marked = sides.join(F.broadcast(hubs), "u", "left")
    light = marked.where("at_hub is null").join(least.where(F.col("n") <= hub), "u").select("u", "v", "m")
    moved = light.union(marked.where("at_hub is not null").select("u", "v", "at_hub"))
    if larger:
        return moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    rest = moved.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.union(least.select("u", F.col("m").alias("v")))
