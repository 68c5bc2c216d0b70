import numpy as np
import pytest
from brute_hdbscan import core_and_reach, hdbscan, tree_weight

from toolgauge.operators import density, neighbors, vector_index

RNG = np.random.default_rng(1)
BLOBS = np.concatenate(
    [
        RNG.normal(0, 0.3, (25, 3)),
        RNG.normal(3, 0.3, (25, 3)),
        RNG.normal((0, 4, 0), 0.6, (20, 3)),
        RNG.uniform(-3, 6, (20, 3)),
    ]
).astype(np.float32)
# A third of all rows is one vector; small multiplicities elsewhere.
COPIES = np.concatenate([BLOBS, np.repeat(BLOBS[:1], 50, 0), np.repeat(BLOBS[60:63], 3, 0)])
# Coarse coordinates: copies and equal distances everywhere.
GRID = np.round(BLOBS)


def rows(spark, x, parts=3):
    data = [(i, [float(v) for v in r], "wrong_tool") for i, r in enumerate(x)]
    return spark.createDataFrame(data, "ord long, embedding array<float>, error_type string").repartition(parts)


def labels(members):
    return [r.cluster_id for r in sorted(members.select("ord", "cluster_id").collect(), key=lambda r: r.ord)]


@pytest.mark.parametrize(
    "x, options",
    [
        (BLOBS, {}),
        (COPIES, {"block_rows": 16}),
        (GRID, {"block_rows": 16}),
        (BLOBS, {"block_rows": 16}),
        (GRID, {}),
    ],
    ids=["one block", "copies", "ties", "blocks", "ties in one block"],
)
def test_clusters_match_brute_force(spark, x, options):
    want = hdbscan(x.astype(np.float64), 5)
    got = labels(density.cluster_members(rows(spark, x), **options))
    assert got == want
    assert len(got) == len(x) and max(want) >= 1 and -1 in want


def test_partitioning_does_not_matter(spark):
    found = [labels(density.cluster_members(rows(spark, BLOBS, p))) for p in (1, 17)]
    assert found[0] == found[1]


@pytest.mark.parametrize("block_rows", [8, 1000])
def test_cores_and_tree_are_exact(spark, block_rows):
    x = RNG.normal(0, 1, (120, 2)).astype(np.float32)
    x[60:] += 40  # far cells, so that pairs of cells and points of pairs get left out
    core, reach = core_and_reach(x.astype(np.float64), 5)
    index = density.index_of(rows(spark, x).select("ord", "embedding"), 5, block_rows)
    cores, tree = density.tree_of(index)
    got = {r.pid: r.core for r in cores.collect()}
    assert np.allclose([got[i] for i in range(len(x))], core, atol=1e-9)
    edges = tree.collect()
    assert len(edges) == len(x) - 1
    assert np.isclose(sum(r.w for r in edges), tree_weight(reach), atol=1e-6)
    assert all(np.isclose(r.w, reach[r.u, r.v]) for r in edges)


def test_far_blocks_are_never_compared(spark):
    x = np.concatenate([RNG.normal(c, 1, (64, 2)) for c in (0, 500, 1000, 1500)]).astype(np.float32)
    index = density.index_of(rows(spark, x).select("ord", "embedding"), 5, 16)
    points = neighbors._with_bounds(index)
    share = vector_index.compared_share(index, neighbors._pairs_for_neighbors(index, points))
    assert 0 < share < 0.25


@pytest.mark.parametrize("n", [0, 4, 5, 6, 9, 10])
def test_small_sets(spark, n):
    x = RNG.normal(0, 1, (n, 4)).astype(np.float32)
    members = density.cluster_members(rows(spark, x))
    summary = density.failure_clusters(members).collect()
    assert sum(r["size"] for r in summary) == n and len(summary) >= 1
    if n < 5:
        assert [(r.cluster_id, r.label) for r in summary] == [(0, "general_failures")]
    else:
        assert labels(members) == hdbscan(x.astype(np.float64), density.min_cluster_size(n))


def test_minimum_cluster_size():
    assert [density.min_cluster_size(n) for n in (5, 6, 9, 10, 1000)] == [2, 3, 4, 5, 5]


def test_rows_without_a_usable_vector_are_noise(spark):
    nan = float("nan")
    rows = [(i, [float(i % 2), 0.01 * i]) for i in range(12)]
    rows += [(50, None), (51, [nan, 0.0]), (52, [1.0]), (53, [None, 1.0]), (54, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "ord long, embedding array<double>")
    got = {r.ord: r.cluster_id for r in density.cluster_members(df).collect()}
    assert len(got) == len(rows) and all(got[i] == -1 for i in range(50, 55))
    few = {r.ord: r.cluster_id for r in density.cluster_members(df.filter("ord IN (0, 1, 50, 51, 52)")).collect()}
    assert few == {0: 0, 1: 0, 50: -1, 51: -1, 52: -1}


def test_chunks_meet_without_a_copy_for_each(spark, monkeypatch):
    """All points are about equally far apart, so every chunk meets every other one."""
    from toolgauge.operators import chunks

    monkeypatch.setattr(chunks, "ROWS", 32)
    x = RNG.normal(0, 1, (400, 48))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    index = density.index_of(rows(spark, x).select("ord", "embedding"), 5, 16)
    assert len(index.chunks.heads) > 8
    cores, tree = density.tree_of(index)
    core, reach = core_and_reach(x.astype(np.float64), 5)
    assert np.allclose([r.core for r in cores.orderBy("pid").collect()], core, atol=1e-9)
    assert np.isclose(sum(r.w for r in tree.collect()), tree_weight(reach), atol=1e-6)
    found = neighbors.nearest(index)
    assert found.count() == 5 * len(x)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
