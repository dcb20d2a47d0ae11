"""Connected components by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradelake.llm.common import written


def _mapped(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``rows`` with ``column`` replaced by its parent where it has one."""
    found = parents.select(F.col("node").alias("_node"), F.col("parent").alias("_parent"))
    return (
        rows.join(found, F.col(column) == F.col("_node"), "left")
        .withColumn(column, F.coalesce("_parent", column))
        .drop("_node", "_parent")
    )


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` of every node in ``edges`` (``a``, ``b``, orderable).

    In a round every node hooks to its smallest neighbour, parents are followed up to
    eight steps, and the edges are contracted; rounds end when no edge is left. Each
    round at least halves the nodes of a component. The root is a component's
    smallest node. Null ends are ignored; an edge to itself makes a component of one.
    """
    edges = edges.filter("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    edges = written(edges.distinct(), "graph-edges")
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
    labels = nodes.withColumn("root", F.col("node"))
    edges = edges.filter("a <> b")
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select("b", "a"))
        parents = both.groupBy("a").agg(F.min("b").alias("parent"))
        parents = parents.select(F.col("a").alias("node"), F.least("a", "parent").alias("parent"))
        parents = written(parents, "graph-parents")
        for _ in range(3):
            parents = _mapped(parents, "parent", parents)
        parents = written(parents, "graph-parents")
        labels = written(_mapped(labels, "root", parents), "graph-labels")
        edges = _mapped(_mapped(edges, "a", parents), "b", parents).filter("a <> b")
        edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "graph-edges")
    return labels
