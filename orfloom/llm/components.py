"""Connected components as DataFrame jobs (alternating star contraction)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orfloom.llm.storage import stored

#: Rounds after which something must be wrong: each at least halves the height of the trees.
MOST_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its least node.

    Large-star links each node's larger neighbours to its least neighbour,
    small-star its smaller ones; both only shuffle edges, the least neighbour
    is a pre-aggregated minimum, and a hub's edges are joined to its one row,
    which adaptive skew handling splits.  Every round, one of each, is a
    written table.
    Loops, repeated edges and nulls are fine; no edges give no rows.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null and a <> b")
    state = stored(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    for _ in range(MOST_ROUNDS):
        both = state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        state = stored(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        state.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
