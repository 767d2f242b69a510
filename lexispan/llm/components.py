"""Connected components of an edge table, labelled by the smallest member."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispan.sources.workspace import materialized

# Up to so many edges, those of one node are little for a task.
FEW_EDGES = 500_000

# How many hubs there are at most.
MOST_HUBS = 100_000


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node with an edge to another one; ``root`` is the smallest node reachable.

    Alternates two steps until nothing changes: all larger neighbours of a node
    are tied to the smallest one it knows, then all smaller ones are. Only
    minima are aggregated. Among very many edges a node may be a *hub* of a large
    part of them: hubs are so few that their minima are broadcast, and the edges of
    a hub stay where they are. Nodes may be of any type that has an order.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = materialized(pairs)
    seen = _state(pairs)
    while seen[0]:
        degree = 2 * seen[0] // MOST_HUBS + 1 if seen[0] > FEW_EDGES else None
        pairs = materialized(_tied(_tied(pairs, F.col("v") > F.col("u"), True, degree), F.col("v") < F.col("u"), False, degree))
        state = _state(pairs)
        if state == seen:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _tied(pairs: DataFrame, moves: Column, both: bool, degree: int | None) -> DataFrame:
    """Neighbours that ``moves`` picks are tied to the least neighbour (or the node itself)."""
    around = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else pairs
    least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
    if degree is None:
        moved = around.where(moves).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # At most MOST_HUBS rows: so many nodes can have so many edges.
        hubs = least.where(F.col("n") > degree).select("u", F.col("m").alias("hub"))
        known = around.where(moves).join(F.broadcast(hubs), "u", "left")
        others = known.where("hub IS NULL").join(least, "u")
        moved = known.where("hub IS NOT NULL").select(F.col("v").alias("u"), F.col("hub").alias("v"))
        moved = moved.unionByName(others.select(F.col("v").alias("u"), F.col("m").alias("v")))
    if not both:
        # Both steps may find a tie twice; one distinct per round is enough.
        moved = moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
    return moved.where("u <> v")
