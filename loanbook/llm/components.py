"""Connected components of a link table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanbook.llm.texts import staged


def _mapped(rows: DataFrame, column: str, labels: DataFrame) -> DataFrame:
    """``rows`` with the values of a column replaced by their labels, if any."""
    named = labels.select(F.col("node").alias("_node"), F.col("component").alias("_component"))
    joined = rows.join(named, F.col(column) == F.col("_node"), "left")
    return joined.withColumn(column, F.coalesce("_component", column)).drop("_node", "_component")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, for every node
    of the links (a, b).

    Each round points every component at its smallest neighbour, follows the
    pointers twice, and keeps the links that still join different components.
    Tables are stored between rounds; nothing but a count reaches the driver.
    """
    links = staged(links.select("a", "b").where("a <> b").distinct(), "links")
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = staged(ends.withColumn("component", F.col("node")), "labels")
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
        for _ in range(2):
            parents = _mapped(parents, "component", parents)
        parents = staged(parents, "parents")
        labels = staged(_mapped(labels, "component", parents), "labels")
        joined = _mapped(_mapped(links, "a", parents), "b", parents)
        links = staged(joined.where("a <> b").distinct(), "links")
    return labels
