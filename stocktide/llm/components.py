"""Connected components of a graph that never leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktide.storage import staged


def _changed(table: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """Replace ``column`` by its parent where it has one. ``parents`` has one row per node, so rows never multiply."""
    above = parents.select(F.col("node").alias(column), "parent")
    return table.join(above, column, "left").withColumn(column, F.coalesce("parent", column)).drop("parent").select(table.columns)


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Each round every node takes its smallest smaller neighbour as parent, parents are followed to the top by pointer
    jumping, and links are drawn anew between the tops. All steps are joins and partial aggregates; each result is stored in
    the shared folder, so lineage stays short. Links with NULL or equal ends are ignored.
    """
    links = staged(links.select("a", "b").filter("a <> b").distinct())
    found = staged(links.select(F.col("a").alias("node")).unionAll(links.select("b")).distinct().withColumn("component", F.col("node")))
    while not links.isEmpty():
        both = links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("parent"))
        parents = staged(both.groupBy("node").agg(F.min("parent").alias("parent")))
        while True:
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            jumped = staged(parents.join(above, "parent", "left").select("node", F.coalesce("top", "parent").alias("parent"), "top"))
            parents = jumped.select("node", "parent")
            if jumped.filter("top IS NOT NULL").isEmpty():
                break
        found = staged(_changed(found, "component", parents))
        links = staged(_changed(_changed(links, "a", parents), "b", parents).filter("a <> b").distinct())
    return found
