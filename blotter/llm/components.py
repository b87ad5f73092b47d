"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``links`` (a, b); root is the smallest
    node that can be reached.

    Each round takes the smallest root among the neighbours, summed up map-side,
    and then that root's root of the round before. The table is written every
    round, so both sides of each join can be split where one node has most links.
    """
    edges = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    roots = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        heard = edges.join(roots, edges.a == roots.node).groupBy(F.col("b").alias("node")).agg(F.min("root").alias("heard"))
        lower = roots.join(heard, "node").select("node", F.col("root").alias("old"), F.least("root", "heard").alias("low"))
        above = roots.select(F.col("node").alias("low"), F.col("root").alias("top"))
        # a root is a node of the table itself, so it has one above it or is its own
        moved = written(lower.join(above, "low").select("node", "old", F.least("low", "top").alias("root")), "roots")
        roots = moved.select("node", "root")
        if not moved.filter("old <> root").limit(1).count():
            return roots
