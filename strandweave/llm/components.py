"""Connected components of a link table, by alternating large and small stars in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strandweave.llm.common import look_up
from strandweave.tables import Workspace


def _least(edges: DataFrame) -> DataFrame:
    """Per node u the least of itself and its neighbours; reduced in every task first."""
    return edges.groupBy("u").agg(F.min("v").alias("near")).select("u", F.least("u", "near").alias("least"))


def components(links: DataFrame, workspace: Workspace) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: bigint); the root is the least node reachable.

    Every round is a saved table, so a lost executor repeats one round at most.  A star's centre
    may have as many neighbours as its component has nodes; it is looked up, never gathered.
    """
    edges = workspace.save(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = None
    while edges.rows:
        both = edges.df.unionByName(edges.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: greater neighbours move to the least one.
        large = look_up(both, _least(both), "u", {"least": "least"}, "v", workspace)
        larger = workspace.write(large.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct(), "large")
        # Small star: a node and its lesser neighbours move to the least of them.
        small = look_up(larger, _least(larger), "u", {"least": "least"}, "v", workspace)
        moved = small.select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(small.select("u", F.col("least").alias("v")))
        edges = workspace.save(moved.where("u <> v").distinct(), "small")
        after = edges.df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).head()
        if after == before:
            break
        before = after
    roots = edges.df.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
