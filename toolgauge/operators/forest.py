"""Spanning trees and components by rounds of contraction on edge tables.

Every round each component picks its lightest edge; picks are hooked together and
the edge table is relabelled. Rounds are logarithmic in the number of vertices. The
tables between rounds are written to the shared folder, so lineage stays short and
a lost executor costs one round, not the run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from toolgauge.session import settle


def _roots(pointers: DataFrame) -> DataFrame:
    """Follow (node, up) to the ends of all chains; a root points to itself.

    Every round makes all pointers three times as long.
    """
    while True:
        second = pointers.select(F.col("node").alias("up"), F.col("up").alias("up2"))
        third = pointers.select(F.col("node").alias("up2"), F.col("up").alias("up3"))
        jumped = settle(
            pointers.join(second, "up")
            .join(third, "up2")
            .select("node", F.col("up3").alias("up"), F.col("up") != F.col("up3"))
            .toDF("node", "up", "_moved")
        )
        pointers = jumped.select("node", "up")
        if jumped.filter("_moved").isEmpty():
            return pointers


def _lightest(edges: DataFrame) -> DataFrame:
    """(node, pick): lightest edge of every component under a total order."""
    pick = F.struct("w", "u", "v", "a", "b")
    return (
        edges.select(F.col("a").alias("node"), pick.alias("pick"))
        .unionAll(edges.select(F.col("b").alias("node"), pick.alias("pick")))
        .groupBy("node")
        .agg(F.min("pick").alias("pick"))
    )


def _relabel(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges between different components only, the lightest of each pair."""
    left = roots.select(F.col("node").alias("a"), F.col("up").alias("ra"))
    right = roots.select(F.col("node").alias("b"), F.col("up").alias("rb"))
    moved = edges.join(left, "a").join(right, "b").filter(F.col("ra") != F.col("rb"))
    return (
        moved.groupBy(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        .agg(F.min(F.struct("w", "u", "v")).alias("e"))
        .select("a", "b", "e.w", "e.u", "e.v")
    )


def contract(
    edges: DataFrame, search: Callable[[DataFrame, DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Minimum spanning forest (u, v, w) and the component (node, up) of each vertex.

    With `search` the edges need not be all there are, as long as they connect all vertices:
    it is given the components (node, up) and the lightest known edge (node, w) out of each,
    and returns (a, b, w, u, v), all lighter ones or at least the lightest out of each.
    """
    live = edges.select(F.col("u").alias("a"), F.col("v").alias("b"), "w", "u", "v")
    vertices = live.select(F.col("a").alias("node")).unionAll(live.select("b")).distinct()
    labels = vertices.select("node", F.col("node").alias("up"))
    forest = edges.select("u", "v", "w").limit(0)
    while not live.isEmpty():
        if search is not None:
            known = _lightest(live).select("node", F.col("pick.w").alias("w"))
            live = live.unionByName(search(labels, known)).transform(settle)
        picks = _lightest(live).transform(settle)
        forest = forest.unionAll(picks.select("pick.u", "pick.v", "pick.w").distinct())
        hooked = picks.select(
            "node",
            F.when(F.col("node") == F.col("pick.a"), F.col("pick.b"))
            .otherwise(F.col("pick.a"))
            .alias("up"),
        )
        # Two components that pick the same edge point at each other: the smaller is root.
        back = hooked.select(F.col("node").alias("up"), F.col("up").alias("back"))
        pointers = hooked.join(back, "up").select(
            "node",
            F.when(
                (F.col("back") == F.col("node")) & (F.col("node") < F.col("up")), F.col("node")
            )
            .otherwise(F.col("up"))
            .alias("up"),
        )
        roots = _roots(pointers)
        live = _relabel(live, roots).transform(settle)
        moved = roots.select(F.col("node").alias("up"), F.col("up").alias("root"))
        labels = (
            labels.join(moved, "up", "left")
            .select("node", F.coalesce("root", "up").alias("up"))
            .transform(settle)
        )
    return forest, labels


def chain_ends(pointers: DataFrame) -> DataFrame:
    return _roots(pointers)
