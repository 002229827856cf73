"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import materialise


def _star(edges: DataFrame) -> DataFrame:
    """Every node with its least neighbour or itself, joined to its edges.
    The least neighbours are pre-aggregated and unique per node, so a node
    with very many edges can be split."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return edges.join(least, "u")


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node
    it is connected with.

    Large and small stars in turn: every node sends its larger neighbours,
    then its smaller ones, to the least of them, until each component is one
    star around its least node.  A round is written out before the next.
    Loops, repeated and reversed edges and nulls are harmless; no edges give
    an empty result.
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v")
    pairs = materialise(pairs.distinct(), "edges")
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        star = _star(large)
        small = star.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        done = materialise(small.select("e.*").where("u != v").distinct(), "edges")
        # Finished when no node is both the end and the middle of an edge and
        # every end has one edge.
        middle = done.join(done.select(F.col("u").alias("w")), F.col("v") == F.col("w"), "left_semi").isEmpty()
        single = done.groupBy("u").count().where("count > 1").isEmpty()
        pairs = done
        if middle and single:
            break
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
