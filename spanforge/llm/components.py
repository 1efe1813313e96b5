"""Connected components of a table of links, by alternating stars, each step a join and a minimum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanforge.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def _least(sides: DataFrame) -> DataFrame:
    """The least of each node ``u`` and its neighbours ``v``, next to each of its links."""
    least = sides.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
    return sides.join(least, "u")


def connected(links: DataFrame) -> DataFrame:
    """``links`` (u, v) in; u, root out: for every linked node that is not the least of its component, that least
    node. Nodes are of any type with an order. Minima are combined before they are shuffled, so a node with very many links is no
    hot group, and only links of a node above itself are passed on. The number of steps grows with the
    logarithm of the size of a component.
    """
    edges = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("v", "u").toDF("u", "v"))
        large = _least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # In the small step each node has only neighbours below it; they and the node go to the least one.
        large = stored(large.where("u <> v").union(both.groupBy("u").agg(F.min("v").alias("v")).where("v < u")).distinct(), "large-stars")
        small = _least(large)
        edges = stored(
            small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "small-stars"
        )
        was, state = state, _state(edges)
        if was == state:
            break
    return edges.select("u", F.col("v").alias("root"))
