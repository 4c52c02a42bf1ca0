"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that the join stands alone in its stage: adaptive execution then splits the
    # links of a node that has very many.
    low = common.materialize(both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low")), "low")
    return (
        both.join(low, "u").where(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("low").alias("v")).where("u != v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = common.materialize(down.groupBy("u").agg(F.min("v").alias("low")), "low")
    moved = down.join(low, "u").where("v != low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return moved.union(low.select("u", F.col("low").alias("v"))).distinct()


def roots(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v); ``root`` is the smallest of its component.

    Every round is written to the shared folder, so a lost executor never repeats earlier
    rounds.  The number of rounds grows with the logarithm of the longest chain.
    """
    edges = common.materialize(edges.where("u != v").select("u", "v").distinct(), "edges")
    state = _state(edges)
    if not state[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        large = common.materialize(_large_star(edges), "edges")
        edges = common.materialize(_small_star(large), "edges")
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
