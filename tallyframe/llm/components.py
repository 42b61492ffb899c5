"""Connected components of a graph of links, by DataFrame joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialise


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def connected_components(links: DataFrame) -> DataFrame:
    """Nodes of the links (a, b) with the smallest node of their component: (node, component).

    Alternates two steps until nothing changes. The large step points the greater neighbours of a
    node at the least one, the small step does the same for the lesser ones; each keeps what is
    connected and at least halves long chains, so chains of length n take about log n rounds.
    A node's least neighbour is an aggregate that is combined before the shuffle, and it is joined
    back to the links, where adaptive execution splits a node with very many of them. Each round is
    written to the shared folder, so that a lost executor costs no earlier round.

    Links with a null end and links from a node to itself are left out; repeated links are merged.
    An empty table gives an empty result.
    """
    found = links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    state, before = materialise(found.distinct(), "links"), None
    while True:
        seen = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen[0] == 0 or seen == before:
            break
        before = seen
        both = _both_ways(state)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where(F.col("b") > F.col("a"))
            .join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b"))
        ).distinct()
        large = materialise(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = (
            small.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b"))
            .unionByName(least.select("a", F.col("m").alias("b")))
        ).distinct()
        state = materialise(small, "links")
    stars = state.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = state.select(F.col("b").alias("node")).distinct()
    return stars.unionByName(
        roots.join(stars.select("node"), "node", "left_anti").withColumn("component", F.col("node"))
    )
