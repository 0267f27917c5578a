"""Connected components of an edge table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of an edge with another node; root is the component's least node.

    ``edges`` has two non-null bigint columns ``a`` and ``b``.  Alternates the
    large-star and small-star steps until the edges no longer change, which takes
    about log(component size) rounds, whatever the component's diameter.  A round
    takes each node's least neighbour with a partially aggregated groupBy and joins
    it back; a hub's edges are only on the join's probe side, which AQE can split.
    Every round is written to the shared checkpoint folder; the one before is deleted.
    An empty edge table gives an empty result.  Self-loops and repeats are ignored.
    """
    current = scratch.save(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    state = _state(current)
    while state[0]:
        after = scratch.save(_small_star(_large_star(current)), "edges")
        scratch.drop(current)
        before, current, state = state, after, _state(after)
        if state == before:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31))), F.lit(0))).first()
    return row[0], row[1]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than the node is hung below the node's least neighbour."""
    both = edges.union(edges.select("v", "u"))  # (node, neighbour)
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour, and the node itself, is hung below the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
