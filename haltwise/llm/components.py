"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haltwise.llm import common


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b): component is its smallest node.

    Each round gives a node the least label among its neighbours and then the label of that
    label, so the rounds needed grow with the logarithm of the longest path. Labels are minima,
    which combine before they are shuffled, so a node with very many edges is no hot group.
    Every round is saved in the shared folder; only a count comes to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = common.save(both.filter("a <> b").distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
    labels = labels.select("node", F.least("node", "near").alias("component"))
    while True:
        labels = common.save(labels, "labels")
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        step = labels.join(near, "node", "left").select(
            "node", F.least("component", "near").alias("low"), "component"
        )
        jump = labels.select(F.col("node").alias("low"), F.col("component").alias("root"))
        new = step.join(jump, "low", "left").select(
            "node",
            F.least("low", F.coalesce("root", "low")).alias("next"),
            F.col("component").alias("was"),
        )
        new = common.save(new, "labels")
        moved = new.filter("next <> was").limit(1).count()
        labels = new.select("node", F.col("next").alias("component"))
        if not moved:
            return labels


def _renamed(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the labels of their ends, each once; those within one label go."""
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("component").alias("to"))
        edges = edges.join(own, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
    return edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def contracted(edges: DataFrame) -> DataFrame:
    """(node, component) like `components`, by contraction: for dense groups.

    Each round every node points to its least lesser neighbour, pointers are followed to their
    ends by doubling, and edges are renamed to them. Only nodes without a lesser neighbour are
    left; in a dense group these are few, so all rounds read little more than the edges once.
    """
    known = None
    edges = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = common.save(edges.distinct(), "edges")
    while True:
        # the greater end points down; a node that is only a lesser end points to itself
        down = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
        roots = edges.select(F.col("a").alias("node")).distinct().join(down, "node", "left_anti")
        labels = down.unionByName(roots.withColumn("component", F.col("node")))
        while True:
            labels = common.save(labels, "labels")
            up = labels.select(F.col("node").alias("component"), F.col("component").alias("top"))
            up = up.filter("component <> top")
            if labels.join(up, "component", "left_semi").isEmpty():
                break
            labels = labels.join(up, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
        if known is None:
            known = labels
        else:
            known = common.save(_composed(known, labels), "labels")
        edges = common.save(_renamed(edges, labels), "edges")
        if edges.isEmpty():
            return known


def _composed(known: DataFrame, labels: DataFrame) -> DataFrame:
    top = labels.select(F.col("node").alias("component"), F.col("component").alias("top"))
    return known.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))


def grown(parts: DataFrame | None, edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes of `parts`, an earlier result, and of further `edges`. Only
    the edges that join different components are gone through."""
    if parts is None:
        return contracted(edges)
    more = contracted(_renamed(edges, parts))
    new = more.join(parts, "node", "left_anti")
    return common.save(_composed(parts, more).unionByName(new), "labels")
