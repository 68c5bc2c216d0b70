"""A tree of pivots over vectors, and the pairs of blocks that can matter to each other.

Every node of more rows than a block is cut again by pivots of its own, level by level, until
its rows fit into a block. Pivots, nodes and blocks are tables; nothing of them passes through
the driver but the first centre, so neither the number of pivots nor the depth has a limit.
Where pivots cannot tell rows apart (all equally far from each other), what is left of a node
after the last level is cut into blocks by hash, which share its centre.

`close_pairs` walks two copies of the tree at once: a pair of nodes is opened only if the
triangle inequality leaves room for what the caller looks for.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from toolgauge.operators import chunks, distance
from toolgauge.session import noted_tables, remove_tables, settle

BLOCK_ROWS = 2048
FAN = 16  # pivots per node and level
_CHUNK = 16_384  # rows of a node that one task assigns at once
# Bounds are compared with this slack, so rounding never drops a pair.
SLACK = 1e-9


@dataclass(frozen=True)
class Index:
    points: DataFrame  # pid, weight, vec, block
    levels: list[DataFrame]  # node, parent, middle, radius, wide; those of the last are blocks
    anchors: DataFrame  # u, v, dist: connects every point to its centres, hence all points
    k: int
    chunks: chunks.Chunks  # the points once more, in files


def distinct_points(vectors: DataFrame) -> DataFrame:
    """One row per different vector: smallest `ord` as id, and its number of copies.

    Copies lie at distance zero from each other. As a weight they change counts, not
    geometry, and a vector that fills a third of the table stays one row.
    """
    return vectors.groupBy(F.col("embedding").alias("vec")).agg(
        F.min("ord").alias("pid"), F.count("*").alias("weight")
    )


def span(a: Column | str, b: Column | str) -> Column:
    """Distance of two vector columns."""

    def square(x, y):
        step = x.cast("double") - y.cast("double")
        return step * step

    return F.sqrt(F.aggregate(F.zip_with(a, b, square), F.lit(0.0), lambda s, x: s + x))


def at_most(value: Column, limit: Column) -> Column:
    return value <= limit * (1 + SLACK) + SLACK


def _assign(key: tuple, rows: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    if rows.empty:
        return rows.assign(center=[], radius=[])[["pid", "weight", "vec", "node", "center", "radius"]]
    pivots = pivots.sort_values("place")
    x, p = distance.matrix(rows["vec"]), distance.matrix(pivots["vec"])
    nearest = np.argmin(distance.pairwise(x, p), axis=1)
    places, ids = pivots["place"].to_numpy()[nearest], pivots["pid"].to_numpy()[nearest]
    return pd.DataFrame(
        {
            "pid": rows["pid"],
            "weight": rows["weight"],
            "vec": rows["vec"],
            "node": [f"{key[0]}.{place}" for place in places],
            "center": ids,
            "radius": distance.direct(x, p[nearest]),
        }
    )


def build(points: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> Index:
    """Index points (pid, weight, vec); `k` is the number of neighbours asked for later.

    The depth follows from the number of rows. A node's `wide` is a distance within which each
    of its points has k others, as far as the spread of it or of a node above tells.
    """
    total = points.count()
    depth = 2 + math.ceil(math.log(total / block_rows, FAN)) if total > block_rows else 0
    # Hash order picks centres all over the table and picks the same ones again.
    in_hash_order = [F.xxhash64("pid"), F.col("pid")]
    first = points.orderBy(*in_hash_order).select("pid", "vec").take(1)
    pid, vec = (first[0].pid, first[0].vec) if first else (0, [])
    middle = F.lit(vec).cast("array<float>") if vec else F.array().cast("array<float>")
    at = points.select(
        "pid",
        "weight",
        "vec",
        F.lit("0").alias("node"),
        F.lit(pid).cast("long").alias("center"),
        span("vec", middle).alias("radius"),
    )
    heads = points.sparkSession.range(1).select(
        F.lit("0").alias("node"), F.lit("").alias("parent"), middle.alias("middle"), F.lit(math.inf).alias("above")
    )
    levels, anchors, older = [], None, []
    columns = ["pid", "weight", "vec", "node", "center", "radius"]
    for level in range(depth + 1):
        with noted_tables() as paths:
            at = settle(at)
        # Nothing but these rows came from the level above.
        remove_tables(at.sparkSession, older)
        older = paths
        own = F.when(F.col("n") > k, 2 * F.col("radius")).otherwise(math.inf)
        nodes = settle(
            at.groupBy("node")
            .agg(F.count("*").alias("n"), F.max("radius").alias("radius"))
            .join(heads, "node")
            .select("node", "parent", "middle", "radius", "n", F.least("above", own).alias("wide"))
        )
        levels.append(nodes.drop("n"))
        links = at.select(F.col("pid").alias("u"), F.col("center").alias("v"), F.col("radius").alias("dist"))
        large = nodes.filter(F.col("n") > block_rows)
        fits = large.isEmpty()
        if level == depth or fits:
            anchors = links if anchors is None else anchors.unionAll(links)
            break
        sized = at.join(nodes.select("node", "n", "wide"), "node")
        rank = Window.partitionBy("node").orderBy(*in_hash_order)
        fan = F.least(F.lit(FAN), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / block_rows)))
        pivots = settle(
            at.withColumn("place", F.row_number().over(rank))
            .filter(F.col("place") <= FAN)
            .join(large.select("node", "n", "wide"), "node")
            .filter(F.col("place") <= fan)
        )
        # A pivot is also a point of the node above: that links the levels.
        links = pivots.select(F.col("pid").alias("u"), F.col("center").alias("v"), F.col("radius").alias("dist"))
        anchors = links if anchors is None else anchors.unionAll(links)
        stay = F.concat("node", F.lit(".0"))
        heads = pivots.select(
            F.concat_ws(".", "node", F.col("place").cast("string")).alias("node"),
            F.col("node").alias("parent"),
            F.col("vec").alias("middle"),
            F.col("wide").alias("above"),
        ).unionAll(
            nodes.filter(F.col("n") <= block_rows).select(
                stay.alias("node"), F.col("node").alias("parent"), "middle", F.col("wide").alias("above")
            )
        )
        # Rows of a node of any size are dealt to tasks of bounded size; its pivots go to each.
        parts = F.ceil(F.col("n") / _CHUNK)
        rows = sized.filter(F.col("n") > block_rows).select(
            F.col("node").alias("group"), F.pmod(F.xxhash64("pid"), parts).alias("part"), "pid", "weight", "vec"
        )
        copies = pivots.select(
            F.col("node").alias("group"),
            F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"),
            "place",
            "pid",
            "vec",
        )
        schema = "pid bigint, weight bigint, vec array<float>, node string, center bigint, radius double"
        moved = (
            rows.groupBy("group", "part")
            .cogroup(copies.groupBy("group", "part"))
            .applyInPandas(_assign, schema)
        )
        kept = sized.filter(F.col("n") <= block_rows).select("pid", "weight", "vec", stay.alias("node"), "center", "radius")
        at = moved.select(*columns).unionAll(kept.select(*columns))
    anchors = anchors.filter(F.col("u") != F.col("v"))
    if fits:
        points = at.select("pid", "weight", "vec", F.col("node").alias("block"))
        return Index(points, levels, anchors, k, chunks.store(points))
    pieces = F.ceil(F.col("n") / block_rows)
    placed = settle(
        at.join(nodes.select("node", "n"), "node").select(
            "pid",
            "weight",
            "vec",
            "radius",
            F.concat_ws(".", "node", F.pmod(F.xxhash64("pid"), pieces).cast("string")).alias("block"),
        )
    )
    of_block = nodes.select(F.col("node").alias("parent"), "middle", "wide")
    blocks = placed.groupBy("block").agg(F.max("radius").alias("radius")).withColumn(
        "parent", F.regexp_extract("block", r"^(.*)\.[^.]*$", 1)
    )
    levels.append(
        settle(
            blocks.join(of_block, "parent").select(F.col("block").alias("node"), "parent", "middle", "radius", "wide")
        )
    )
    points = placed.drop("radius")
    return Index(points, levels, anchors, k, chunks.store(points))


def close_pairs(
    index: Index,
    facts: DataFrame,
    merge: dict[str, Callable[[str], Column]],
    near: Callable[[Column], Column],
    ordered: bool,
) -> DataFrame:
    """Pairs (a, b) of blocks that `near` accepts, at every level above too.

    `facts` has one row per block; `merge` tells how a column of it becomes that of a node.
    `near` gets the least distance between two nodes and sees their facts as a_... and b_...;
    a node must be accepted whenever one of its blocks is. Unless `ordered`, a pair and its
    reverse come once.
    """
    facts = settle(facts)
    # The pair of the root with itself is always opened, unless the root is a block.
    top = 1 if len(index.levels) > 1 else 0
    root = F.lit("0" if top else "")
    pairs = facts.sparkSession.range(1).select(root.alias("a"), root.alias("b"))
    for level, nodes in list(enumerate(index.levels))[top:]:
        merged = facts.groupBy(F.substring_index("block", ".", level + 1).alias("node")).agg(
            *[how(name).alias(name) for name, how in merge.items()]
        )
        named = nodes.select("node", "parent", "middle", "radius").join(merged, "node")
        left = named.toDF(*[f"a_{c}" for c in named.columns])
        right = named.toDF(*[f"b_{c}" for c in named.columns])
        opened = pairs.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"))
        opened = opened.join(left, F.col("up_a") == F.col("a_parent")).join(right, F.col("up_b") == F.col("b_parent"))
        if not ordered:
            opened = opened.filter((F.col("up_a") != F.col("up_b")) | (F.col("a_node") <= F.col("b_node")))
        gap = F.greatest(span("a_middle", "b_middle") - F.col("a_radius") - F.col("b_radius"), F.lit(0.0))
        pairs = opened.filter(near(gap)).withColumnsRenamed({"a_node": "a", "b_node": "b"})
    return pairs.drop("up_a", "up_b", "a_parent", "b_parent")


def compared_share(index: Index, pairs: DataFrame) -> float:
    """Share of all ordered pairs of points that lie in the given pairs of blocks."""
    sizes = index.points.groupBy("block").agg(F.count("*").alias("n"))
    both = pairs.join(sizes.toDF("a", "na"), "a").join(sizes.toDF("b", "nb"), "b")
    row = both.agg(F.sum(F.col("na") * F.col("nb")).alias("met")).first()
    return float(row.met or 0) / max(1, index.points.count()) ** 2
