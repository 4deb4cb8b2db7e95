"""Connected components by alternating large-star and small-star steps, on written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch


def _step(edges: DataFrame, large: bool, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Hangs each node's larger (or not larger) neighbours under the least of its neighbourhood.

    The edges, and a table that may go when they are written. That table is written first, so that the join with it reads
    two exchanges and Spark can split a node with very many neighbours.
    """
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    least = scratch.save(least, "least")
    hung = near.join(least, "u")
    if large:
        out = hung.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v"), least


def _is_done(edges: DataFrame) -> bool:
    """Whether the edges are stars: no node hangs under two others, or both hangs and has some hang under it."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    return ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).where("hangs > 1 or hangs = 1 and holds = 1").isEmpty()


def connected_components(nodes: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(id, comp) for nodes(id) and links(a, b): comp is the least id that links reach from id, itself included."""
    edges, old = links.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v"), None
    while True:
        large, one = _step(edges, True, scratch)
        large = scratch.save(large, "large")
        small, two = _step(large, False, scratch)
        edges = scratch.save(small.distinct(), "edges")
        scratch.drop(one, two, large, *([] if old is None else [old]))
        if _is_done(edges):
            break
        old = edges
    # Every edge now leads from a node to the least of its component.
    out = scratch.save(nodes.join(edges, nodes["id"] == edges["u"], "left").select("id", F.coalesce("v", "id").alias("comp")), "components")
    scratch.drop(edges)
    return out
