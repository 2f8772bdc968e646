"""Connected components of a graph of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postingloom.llm.common import stored


def connected_components(links: DataFrame, purpose: str = "components", most_rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node reachable.

    Each round points every node at the smallest neighbour, first from the larger
    side, then from the smaller; rounds grow with the logarithm of a component.
    The state is written to the shared folder after each half round. A node with
    very many links is split by the adaptive join, and minima combine in the map
    tasks. Links from a node to itself and repeated links change nothing; no
    links give no rows.
    """
    state = stored(
        links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), f"{purpose}-links"
    )
    before = None
    for _ in range(most_rounds):
        state = stored(_small_star(_large_star(state)), f"{purpose}-stars")
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("v", "m").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return state.select(F.col("v").alias("node"), F.col("m").alias("root")).union(
        state.select("m", "m").distinct()
    ).distinct()


def _large_star(state: DataFrame) -> DataFrame:
    """Larger neighbours of u go to the smallest of u and its neighbours."""
    both = state.select(F.col("v").alias("u"), F.col("m").alias("n")).unionByName(
        state.select(F.col("m").alias("u"), F.col("v").alias("n"))
    )
    least = both.groupBy("u").agg(F.min("n").alias("least"))
    return (
        both.where("n > u")
        .join(least, "u")
        .select(F.col("n").alias("v"), F.least("u", "least").alias("m"))
        .distinct()
    )


def _small_star(state: DataFrame) -> DataFrame:
    """u and its smaller neighbours go to the smallest of them."""
    least = state.groupBy("v").agg(F.min("m").alias("least"))
    moved = state.join(least, "v").where("m <> least").select(F.col("m").alias("v"), F.col("least").alias("m"))
    return moved.union(least.select("v", F.col("least").alias("m"))).where("v <> m").distinct()
