"""Connected components of links between numbers, in rounds of joins.

Each round lets every node point to its smallest neighbour below it, follows the pointers to their ends by doubling,
and replaces both ends of every link by where they lead; links within one component vanish. Every step writes its
table below the shared folder, and no link or label is brought to the driver, only counts are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import stored


def followed(pointers: DataFrame) -> DataFrame:
    """(node, to) rows with `to` replaced by the end of the chain that starts there."""
    while True:
        a, b = pointers.alias("a"), pointers.alias("b")
        steps = a.join(b, F.col("a.to") == F.col("b.node"), "left").select(
            F.col("a.node").alias("node"),
            F.coalesce("b.to", "a.to").alias("to"),
            F.col("b.to").isNotNull().alias("moved"),
        )
        steps = stored(steps, "component-pointers")
        pointers = steps.select("node", "to")
        if not steps.filter("moved").limit(1).count():
            return pointers


def renamed(table: DataFrame, column: str, pointers: DataFrame) -> DataFrame:
    """A column of nodes replaced by where they point; nodes without a pointer stay."""
    t, p = table.alias("t"), pointers.alias("p")
    others = [F.col(f"t.{c}") for c in table.columns if c != column]
    end = F.coalesce("p.to", f"t.{column}").alias(column)
    return t.join(p, F.col(f"t.{column}") == F.col("p.node"), "left").select(*others, end)


def components(links: DataFrame) -> DataFrame:
    """(a, b) links to (node, component) for every node that is linked to a smaller one, directly or not."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    links = stored(links, "component-links")
    labels = None
    while links.limit(1).count():
        pointers = followed(stored(links.groupBy("a").agg(F.min("b").alias("to")).withColumnRenamed("a", "node"), "component-least"))
        if labels is None:
            labels = pointers.withColumnRenamed("to", "component")
        else:
            # A node that is renamed for the first time in this round has no label yet.
            older = renamed(labels, "component", pointers)
            newer = pointers.join(labels, "node", "left_anti").withColumnRenamed("to", "component")
            labels = stored(older.select("node", "component").unionAll(newer.select("node", "component")), "component-labels")
        moved = renamed(renamed(links, "a", pointers), "b", pointers)
        moved = moved.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        links = stored(moved, "component-links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
