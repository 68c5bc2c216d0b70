"""Density clustering of failures: the whole chain from vectors to clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from toolgauge.operators import clusters, neighbors, vector_index
from toolgauge.operators.forest import contract
from toolgauge.operators.hierarchy import leaf_clusters, select_clusters
from toolgauge.operators.ranking import dense_positions
from toolgauge.operators.vector_index import BLOCK_ROWS, Index
from toolgauge.session import settle

# Fewer failures than this form one cluster without a look at their vectors.
MIN_FAILURES = 5
# Limits of the minimum cluster size.
SMALLEST_CLUSTER, LARGEST_MINIMUM = 2, 5

CLUSTERS_PER_BUCKET = 100_000


def min_cluster_size(failures: int) -> int:
    return max(SMALLEST_CLUSTER, min(LARGEST_MINIMUM, failures // 2))


def usable(rows: DataFrame) -> Column:
    """True for an `embedding` of finite numbers, as long as most of the others are."""
    embedding = F.col("embedding")
    usual = rows.agg(F.mode(F.size("embedding"), deterministic=True)).scalar()
    broken = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(embedding) == usual) & ~broken, F.lit(False))


def index_of(vectors: DataFrame, m: int, block_rows: int = BLOCK_ROWS) -> Index:
    """Index of distinct vectors; `m` is both minimum cluster size and neighbour count."""
    points = vector_index.distinct_points(vectors).transform(settle)
    return vector_index.build(points, m, block_rows)


def mutual_reachability(found: DataFrame, cores: DataFrame) -> DataFrame:
    """Neighbour pairs with the larger of both core distances and their own distance."""
    own, other = cores.select("pid", "core"), cores.select("pid", "core")
    return (
        found.join(own, "pid")
        .join(other.toDF("neighbor", "other_core"), "neighbor")
        .select(
            "pid",
            "neighbor",
            "dist",
            F.greatest("dist", "core", "other_core").alias("reachability"),
        )
    )


def as_floats(column: str) -> Column:
    """A vector as 32-bit numbers, without negative zeros."""
    return F.transform(F.col(column).cast("array<float>"), lambda x: x + F.lit(0.0).cast("float"))


def _digest(vector: Column) -> Column:
    return F.xxhash64(vector)


def by_vector(rows: DataFrame, column: str, named: DataFrame) -> DataFrame:
    """Rows joined with the facts of their vector; `named` has `vec`, one row for each that occurs.

    Rows carry a number of 64 bits in place of the vector. Vectors whose numbers meet by
    accident are told apart by themselves. A hot vector has one row on the other side.
    """
    named = settle(named.withColumn("_digest", _digest(F.col("vec"))))
    shared = named.groupBy("_digest").agg(F.count("*").alias("_n")).filter("_n > 1").select("_digest")
    alone = named.join(shared, "_digest", "left_anti").drop("vec")
    several = named.join(shared, "_digest", "left_semi").withColumnRenamed("_digest", "_other")
    rows = rows.withColumn("_digest", _digest(F.col(column)))
    met = rows.join(several, (F.col("_digest") == F.col("_other")) & (F.col(column) == F.col("vec")))
    return rows.join(alone, "_digest").drop("_digest").unionByName(met.drop("_digest", "_other", "vec"))


def tree_of(index: Index, owners: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Core distances and the spanning tree under mutual reachability.

    Of edges of equal weight that with the smaller (u, v) is taken, so the tree is unique.
    With `owners` (pid, _set) there is a tree for each set; sets must be farther from each
    other than any two points of one set.
    """
    found = settle(neighbors.nearest(index, max(index.k, neighbors.KNOWN)))
    cores = neighbors.core_distances(index, found).transform(settle)
    edges = settle(neighbors.known_edges(index, found, cores))
    if owners is not None:
        edges = settle(neighbors.edges_inside(index, edges, cores, owners))
    tree, _ = contract(edges, neighbors.edge_search(index, cores, found))
    return cores, tree.transform(settle)


def cluster_members(
    failures: DataFrame,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Failures (with `ord` and `embedding`) plus `cluster_id`; -1 is noise.

    Clusters are numbered in the order of their first members. Rows without a usable
    vector take no part in the distances and come back as noise.
    """
    sound = usable(failures)
    found = failures.groupBy(sound.alias("sound")).count().collect()  # two rows at most
    counts = {row["sound"]: row["count"] for row in found}
    count = counts.get(True, 0)
    if sum(counts.values()) < MIN_FAILURES:
        return failures.withColumn("cluster_id", F.lit(0).cast("long"))
    odd = failures.filter(~sound).withColumn("cluster_id", F.lit(clusters.NOISE).cast("long"))
    if count < MIN_FAILURES:
        return failures.filter(sound).withColumn("cluster_id", F.lit(0).cast("long")).unionByName(odd)
    failures = failures.filter(sound)
    m = min_cluster_size(count)
    # Vectors are compared, and matched to their labels, as 32-bit numbers.
    failures = failures.withColumn("_vec", as_floats("embedding"))
    index = index_of(failures.select("ord", F.col("_vec").alias("embedding")), m, block_rows)
    cores, tree = tree_of(index)
    chosen = select_clusters(leaf_clusters(tree, cores, m))
    # Without an edge, as where all vectors are equal, there is nothing to choose from: noise.
    named = index.points.select("pid", "vec").join(chosen, "pid", "left").transform(settle)
    firsts = (
        named.filter(F.col("cluster").isNotNull())
        .groupBy("cluster")
        .agg(F.min("pid").alias("first"))
        .withColumn("_bucket", F.floor(F.col("first") / CLUSTERS_PER_BUCKET))
    )
    numbers = dense_positions(firsts, ["_bucket"], ["first"], "cluster_id")
    labels = named.join(numbers.select("cluster", "cluster_id"), "cluster", "left").select(
        "vec", F.coalesce("cluster_id", F.lit(clusters.NOISE)).cast("long").alias("cluster_id")
    )
    members = by_vector(failures, "_vec", labels).drop("_vec")
    return members.unionByName(odd) if counts.get(False) else members


def failure_clusters(members: DataFrame) -> DataFrame:
    """One row per cluster; a set too small to cluster is one general cluster."""
    summary = clusters.summarise(members)
    total = members.agg(F.count("*").alias("n"))
    small = total.filter(F.col("n") < MIN_FAILURES).select(
        F.lit(0).cast("long").alias("cluster_id"),
        F.lit(clusters.GENERAL_LABEL).alias("label"),
        F.col("n").alias("size"),
        members.agg(F.min("ord")).scalar().alias("cluster_ord"),
    )
    large = summary.filter(total.scalar() >= MIN_FAILURES)
    return large.unionByName(small)
