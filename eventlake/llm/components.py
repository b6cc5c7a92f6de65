"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.llm.shared import stored


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of the edges (a, b); the root is the component's least node.

    Each round hangs every node's larger neighbours on its least neighbour, then every node and
    its smaller neighbours on the least of them, until nothing changes. The number of rounds grows
    with the logarithm of the longest path. Rounds are written to the shared folder; per node only
    a minimum is kept, so a node with most of the edges does not gather them in one task.
    Self-loops and nulls are ignored.
    """
    low, high = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    links = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(low, high).distinct()
    links, before = stored(links, "links"), None
    for _ in range(max_rounds):
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))
        ).first()
        if state == before:
            roots = links.select(F.col("high").alias("node"), F.col("low").alias("root"))
            own = links.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
            return roots.unionByName(own)
        before = state
        links = stored(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _large_star(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours, linked to the least of the node and its neighbours."""
    least = links.groupBy(F.col("high").alias("low")).agg(F.min("low").alias("least"))
    return links.join(least, "low", "left").select(
        F.coalesce("least", "low").alias("low"), "high"
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours, linked to the least of these."""
    least = links.groupBy("high").agg(F.min("low").alias("least"))
    joined = links.join(least, "high")
    own = least.select(F.col("least").alias("low"), "high")
    others = joined.where("low <> least").select(
        F.col("least").alias("low"), F.col("low").alias("high")
    )
    return own.unionByName(others).distinct()
