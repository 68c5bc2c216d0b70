"""Density clustering of the failures of many evaluations at once.

Every set of failures is clustered by itself, yet all sets go through the same rounds. Two more
coordinates place them on a grid whose step is longer than any distance inside a set, so
nearest neighbours lie in the own set, and the index never opens pairs of different ones. The
spanning trees of all sets form one forest, whose hierarchies grow side by side. Sets differ in
their minimum cluster size, of which there are four at most; each size has rounds of its own.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from toolgauge.operators import clusters, density
from toolgauge.operators.hierarchy import leaf_clusters, select_clusters
from toolgauge.operators.ranking import dense_positions
from toolgauge.operators.vector_index import BLOCK_ROWS
from toolgauge.session import settle

_BUCKETS = 4096


def _sets(failures: DataFrame, keys: list[str]) -> DataFrame:
    """One row per set: its keys, `_set` from 0 on, `_all` and `_usable` rows, `_m` if there are enough."""
    counted = failures.groupBy(*keys).agg(
        F.count("*").alias("_all"), F.sum(F.col("_sound").cast("long")).alias("_usable")
    )
    enough = F.least(F.col("_all"), F.col("_usable")) >= density.MIN_FAILURES
    least, most = density.SMALLEST_CLUSTER, density.LARGEST_MINIMUM
    size = F.greatest(F.lit(least), F.least(F.lit(most), F.floor(F.col("_usable") / 2).cast("int")))
    placed = counted.withColumn("_m", F.when(enough, size)).withColumn(
        "_bucket", F.pmod(F.xxhash64(*keys), F.lit(_BUCKETS))
    )
    return settle(dense_positions(settle(placed), ["_bucket"], keys, "_set").drop("_bucket"))


def _same(keys: list[str], left: str, right: str) -> Column:
    """Equality of all keys, by name pattern; a null key is a key like any other."""
    return reduce(Column.__and__, [F.col(left.format(key)).eqNullSafe(F.col(right.format(key))) for key in keys])


def _with_set(rows: DataFrame, sets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the facts of their set."""
    renamed = sets.select(*[F.col(key).alias(f"_of_{key}") for key in keys], "_set", "_all", "_m")
    return rows.join(renamed, _same(keys, "{}", "_of_{}")).drop(*[f"_of_{key}" for key in keys])


def _in_order(sound: DataFrame) -> DataFrame:
    """Rows with `_row`, a number that grows with (set, ord)."""
    # Ranges depend on a sample, so the numbers are stored with the rows.
    ranges = sound.repartitionByRange("_set", "ord").sortWithinPartitions("_set", "ord")
    return settle(ranges.withColumn("_row", F.monotonically_increasing_id()))


def _apart(rows: DataFrame, sets: int) -> Column:
    """The vector as 32-bit numbers, with two more that keep the sets apart."""
    square = F.aggregate(
        F.col("embedding"), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
    )
    longest = math.sqrt(rows.agg(F.max(square)).first()[0] or 0.0)
    # A power of two: multiples stay exact as 32-bit numbers.
    step = 2.0 ** math.ceil(math.log2(4 * longest + 1))
    side = math.isqrt(max(sets - 1, 0)) + 1
    place = F.array(F.floor(F.col("_set") / side) * step, (F.col("_set") % side) * step)
    return F.concat(density.as_floats("embedding"), place.cast("array<float>"))


def cluster_sets(failures: DataFrame, keys: list[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Failures (`keys`, `ord`, `embedding`, ...) plus `cluster_id` within their set; -1 is noise.

    For every set the result of `density.cluster_members` on its rows alone; only the usual
    length of a vector is that of all sets together. A null key is a key like any other.
    """
    columns = failures.columns
    # Where failures come from may be costly (parsing of all answers), so it runs once; all steps
    # read what is stored, and of that only the columns they need.
    rows = settle(failures.withColumn("_at", F.monotonically_increasing_id()))
    rows = rows.withColumn("_sound", density.usable(rows))
    sets = _sets(rows, keys)
    sound = rows.filter("_sound").select(*keys, "_at", "ord", "embedding")
    placed = _in_order(_with_set(sound, sets.filter("_m IS NOT NULL"), keys))
    vectors = settle(placed.select("_row", "_at", "_set", "_m", _apart(placed, sets.count()).alias("_vec")))
    found = None
    for m in [row["_m"] for row in vectors.select("_m").distinct().collect()]:  # four at most
        one = _clusters_of(vectors.filter(F.col("_m") == m), m, block_rows)
        found = one if found is None else found.unionByName(one)
    # Sets with too few rows, or too few vectors, are one cluster.
    alone = F.when(F.col("_sound") | (F.col("_all") < density.MIN_FAILURES), 0).otherwise(clusters.NOISE)
    rows = _with_set(rows, sets, keys)
    if found is None:
        return rows.withColumn("cluster_id", alone.cast("long")).select(*columns, "cluster_id")
    known = settle(density.by_vector(vectors.drop("_m"), "_vec", _numbered(settle(found))).select("_at", "cluster_id"))
    rest = F.when(F.col("_m").isNull(), alone).otherwise(clusters.NOISE)
    return rows.join(known, "_at", "left").select(
        *columns, F.coalesce("cluster_id", rest).cast("long").alias("cluster_id")
    )


def _clusters_of(vectors: DataFrame, m: int, block_rows: int) -> DataFrame:
    """(pid, vec, _set, cluster) for the points of all sets with this minimum cluster size."""
    index = density.index_of(vectors.select(F.col("_row").alias("ord"), F.col("_vec").alias("embedding")), m, block_rows)
    owners = vectors.select(F.col("_row").alias("pid"), "_set").join(index.points.select("pid"), "pid", "left_semi").transform(settle)
    cores, trees = density.tree_of(index, owners)
    chosen = select_clusters(leaf_clusters(trees, cores, m))
    return index.points.select("pid", "vec").join(owners, "pid").join(chosen, "pid", "left")


def _numbered(found: DataFrame) -> DataFrame:
    """(vec, cluster_id): clusters of a set numbered in the order of their first members."""
    firsts = (
        found.filter(F.col("cluster").isNotNull())
        .groupBy("_set", "cluster").agg(F.min("pid").alias("first"))
        .withColumn("_bucket", F.floor(F.col("first") / density.CLUSTERS_PER_BUCKET))
    )
    # Row numbers grow with the set, so the clusters of one set stand together.
    placed = settle(dense_positions(firsts, ["_bucket"], ["first"], "_at"))
    start = placed.groupBy("_set").agg(F.min("_at").alias("_start"))
    numbers = placed.join(start, "_set").select("cluster", (F.col("_at") - F.col("_start")).alias("cluster_id"))
    return found.join(numbers, "cluster", "left").select(
        "vec", F.coalesce("cluster_id", F.lit(clusters.NOISE)).cast("long").alias("cluster_id")
    )


def set_clusters(members: DataFrame, keys: list[str]) -> DataFrame:
    """One row per set and cluster; a set too small to cluster is one general cluster."""
    summary = clusters.summarise(members, *keys)
    totals = summary.groupBy(*keys).agg(F.sum("size").alias("_total"))
    label = F.when(F.col("_total") < density.MIN_FAILURES, clusters.GENERAL_LABEL).otherwise(F.col("s.label"))
    return summary.alias("s").join(totals.alias("t"), _same(keys, "s.{}", "t.{}")).select(
        *[F.col(f"s.{key}").alias(key) for key in keys], "cluster_id", label.alias("label"), "size", "cluster_ord",
        F.col("_total").alias("failures"),
    )
