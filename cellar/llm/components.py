"""Connected components of an edge table, by joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import materialize

MAX_ROUNDS = 60  # rounds grow with the logarithm of the longest path


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); the root is the smallest node it is connected with.

    Large-star and small-star rounds: first every node hands its larger
    neighbours to its smallest neighbour, then each node's smaller neighbours,
    until every node hangs on its root. Nothing is collected per node, so a node
    with many neighbours is an ordinary aggregate and join. Null and looping
    edges are ignored. Each round is written to the shared folder.
    """
    hi, lo = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    now = materialize(edges.where("a <> b").select(hi, lo).distinct(), "component-edges")
    state = _state(now)
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "component-edges")
        before, state = state, _state(now)
        if state == before:
            break
    else:
        raise RuntimeError(f"no stable components after {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h.cast("decimal(20,0)")), F.bit_xor(h)).first())
