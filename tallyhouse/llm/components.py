"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyhouse.llm.base import discard
from tallyhouse.session import materialize

MAX_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step; edges are (u, v) with u > v.

    The minimum of a node is an aggregate with a map-side step, and a node with very many edges is
    joined to its one minimum, which skew handling can split.
    """
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(low, "u")
    moved = small.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """``node, component`` for every node with an edge; the component is its smallest node.

    Null ends and loops are left out; repeated edges count once; no edges give no rows.
    """
    pairs = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
    now = materialize(pairs.where(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") > F.col("v"))).distinct(), "components")
    state = None
    for _ in range(MAX_ROUNDS):
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum("v")).first()
        if seen[0] == 0 or tuple(seen) == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = tuple(seen)
        before, now = now, materialize(_stars(now), "components")
        discard(before)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
