"""Connected components of a link table, by repeated contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b); component is the smallest node.

    Each round joins every vertex to its smallest neighbour, twice over, and
    replaces the links by those between the merged vertices. A component's
    smallest vertex never moves, so the labels end there. State is cut into the
    shared checkpoint folder each round; the links left bound its size.
    """
    ordered = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = cut_lineage(ordered.where("a <> b").distinct(), links.count())
    labels = None
    all_nodes = 0
    while n := edges.count():
        all_nodes = all_nodes or 2 * n
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m"))
                           .select(F.col("a").alias("node"), F.least("a", "m").alias("parent")), 2 * n)
        hop = near.select(F.col("node").alias("parent"), F.col("parent").alias("grand"))
        step = cut_lineage(near.join(hop, "parent", "left")
                           .select("node", F.coalesce("grand", "parent").alias("parent")), 2 * n)
        if labels is None:
            labels = step.withColumnRenamed("parent", "component")
        else:
            moved = step.select(F.col("node").alias("component"), "parent")
            labels = cut_lineage(labels.join(moved, "component", "left")
                                 .select("node", F.coalesce("parent", "component").alias("component")), all_nodes)
        at = lambda col: step.select(F.col("node").alias(col), F.col("parent").alias(f"{col}2"))
        edges = cut_lineage(edges.join(at("a"), "a").join(at("b"), "b")
                            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                            .where("a <> b").distinct(), n)
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
