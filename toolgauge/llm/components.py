"""Connected components by alternating stars, over tables in the shared folder.

Each round every node learns the smallest neighbour through an aggregate with a partial
form, and hands it to its neighbours through a join whose other side has one row per node.
Nothing is grouped into lists, so a node with very many links is no hot group: adaptive
execution splits the join. The number of rounds grows with the logarithm of the graph.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from toolgauge.session import settle


def components(links: DataFrame) -> DataFrame:
    """a, b (numbers) -> node, component: the smallest node reachable. Nodes without links are left out."""
    edges, marks = _settled(
        links.filter("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while True:
        # Large star: neighbours above a node are linked to the smallest around it.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = settle(
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: neighbours below a node, and the node, are linked to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before = marks
        edges, marks = _settled(small.union(least.select("u", F.col("m").alias("v"))).distinct())
        if marks == before:
            # A fixed point consists of stars: every node has one link, to its component.
            roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The links as a table, with their number and checksums that ignore order.

    The checksums are taken while the table is written.
    """
    seen = Observation()
    marks = [
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("one"),
        F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("two"),
    ]
    table = settle(edges.observe(seen, *marks))
    return table, tuple(seen.get[name] for name in ("n", "one", "two"))
