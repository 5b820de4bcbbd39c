"""Connected components of a link table, in rounds of star operations. Nothing of the graph is held by the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtables.llm.common import stored


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of all nodes of (a, b), where component is the smallest node reachable.

    Large stars and small stars take turns until every node points at its smallest one. Each round works on the links
    that are left, at most one per node after the first, and writes them to the shared folder. A hub with many
    links is summed up before the shuffle, and the join with its one row can be split by Spark.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, name)
    while not _is_star_forest(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stored(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), name)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)


def _is_star_forest(edges: DataFrame) -> bool:
    """Has every node one link, to a smaller node that has none? Then that is the smallest of its component."""
    several = edges.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a")
    passed_on = edges.select(F.col("b").alias("a")).distinct().join(edges.select("a").distinct(), "a", "left_semi")
    return several.unionByName(passed_on).isEmpty()
