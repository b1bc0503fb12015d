"""Connected components of a graph given as an edge table, by star contraction.

Each round hangs every larger neighbour of a node, and the node itself, on the smallest node of its
neighbourhood (large star, then small star). Rounds end when a round changes nothing; their number
grows with the logarithm of the graph's size. Minima are combined before each shuffle, and the rows
of a hub meet its single minimum in a join that adaptive execution splits. Every round is stored in the
shared folder, so a lost executor costs one round at most, the planner knows how few edges are left, and
the round's shuffle files go with it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankstream.llm.common import settle, shuffles_dropped


def _hang(pairs: DataFrame) -> DataFrame:
    """(node, least): the smallest neighbour of each node."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _hang(both).select("u", F.least("u", "m").alias("m"))
    larger = both.filter("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _hang(edges)
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(kept).distinct()


def connected_components(
    edges: DataFrame, stage: Callable[[DataFrame, str], DataFrame] = settle
) -> DataFrame:
    """(node, root) for every node of an edge; the root is the smallest node it can reach.

    ``edges`` has two columns of one ordered type. Null ends and loops link nothing; repeated
    edges count once; no edges give no rows. ``stage`` stores a round's edges and reads them back.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    current = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(a.isNotNull() & b.isNotNull() & (a != b))
        .distinct(),
        "edges",
    )

    def state(df: DataFrame):
        digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        with shuffles_dropped(df.sparkSession):
            return tuple(df.agg(F.count(F.lit(1)), digest).first())

    before = state(current)
    while before[0]:
        current = stage(_small_star(_large_star(current)), "edges")
        after = state(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
