"""Connected components of an edge table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import drop_scratch, write_scratch


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b: long; repeated edges, loops and
    either direction allowed). The component is one of its nodes' ids, the same for all.

    Each round every node moves to the smallest of itself and its neighbours, in the order of a
    hash that changes with the round, and the edges follow; loops and repeats go. The hash order
    makes the expected number of rounds logarithmic however the ids run along a chain. Every
    round is written to the shared folder.
    """
    edges = write_scratch(edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b").distinct(), "edges")
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    moved = write_scratch(nodes.select("node", F.col("node").alias("component")), "moved")
    edges_now, level = edges.where("a <> b"), 0
    while not edges_now.isEmpty():
        def ranked(c: str, seed: int = level):
            return F.struct(F.xxhash64(F.col(c), F.lit(seed)).alias("h"), F.col(c).alias("id"))

        both = edges_now.select("a", "b").unionByName(edges_now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = write_scratch(both.groupBy("a").agg(F.min(ranked("b")).alias("least")).select(
            F.col("a").alias("from"), F.least(F.col("least"), ranked("a"))["id"].alias("to")), "step")
        new_edges = edges_now.join(step.withColumnsRenamed({"from": "a", "to": "x"}), "a").join(
            step.withColumnsRenamed({"from": "b", "to": "y"}), "b").where("x <> y").select(
            F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        new_edges = write_scratch(new_edges, "edges")
        new_moved = write_scratch(moved.join(step, F.col("component") == F.col("from"), "left").select(
            "node", F.coalesce("to", "component").alias("component")), "moved")
        for old in (edges, moved, step):
            drop_scratch(old)
        edges, moved, level = new_edges, new_moved, level + 1
        edges_now = edges
    drop_scratch(edges)
    return moved
