"""Connected components of a graph that is too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved


def _nearest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, the node itself included; one row per node, summed map-side."""
    return saved(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))


def connected_components(links: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links``; the component is its smallest node.

    Large-star and small-star steps in turn. Each links the neighbours of a node to their smallest one and
    never lists pairs of them, so a node with very many links costs one row per link. The joins are between
    two fresh shuffles, which adaptive execution splits when one node holds much of them. Links with a NULL
    end and links of a node to itself are ignored. Ends when a round changes no edge.
    """
    edges = saved(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    before = None
    for _ in range(rounds):
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if state.n == 0 or state == before:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = saved(
            both.join(_nearest(both), "u")
            .filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        nearest = _nearest(large)
        small = large.join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(
            small.filter(F.col("u") > F.col("v"))
            .unionByName(nearest.select("u", F.col("m").alias("v")))
            .distinct()
        )
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
