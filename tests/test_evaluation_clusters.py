import numpy as np
import pytest
from brute_hdbscan import hdbscan
from pyspark.sql import functions as F
from test_density import BLOBS, COPIES, GRID, labels
from test_density import rows as as_rows

from toolgauge.operators import density, evaluation_clusters

RNG = np.random.default_rng(9)
SETS = {
    ("a", 1): BLOBS,
    ("a", 2): GRID[:60],
    ("b", 1): COPIES[-70:],
    (None, 1): RNG.normal(0, 1, (9, 3)).astype(np.float32),
    ("b", 2): RNG.normal(0, 1, (6, 3)).astype(np.float32),
    ("b", None): RNG.normal(0, 1, (4, 3)).astype(np.float32),
    ("c", 1): np.repeat(BLOBS[:1], 12, 0),
}


@pytest.fixture(scope="module")
def failures(spark):
    """Sets of all sizes, most of which hold the same vectors and all the same `ord`s."""
    data = [
        (*key, i, [float(v) for v in vector], "wrong_tool" if i % 3 else "missing_param")
        for key, x in SETS.items()
        for i, vector in enumerate(x)
    ]
    data += [("d", 1, i, [1.0] if i % 2 else None, "wrong_tool") for i in range(7)]
    schema = "run_id string, iteration long, ord long, embedding array<double>, error_type string"
    return spark.createDataFrame(data, schema).repartition(5)


def test_every_set_is_clustered_as_if_alone(failures):
    keys = ["run_id", "iteration"]
    found = evaluation_clusters.cluster_sets(failures, keys, block_rows=16)
    assert found.columns == [*failures.columns, "cluster_id"]
    got = {}
    for r in found.collect():
        got.setdefault((r.run_id, r.iteration), {})[r.ord] = r.cluster_id
    assert set(got) == {*SETS, ("d", 1)}
    for key, x in SETS.items():
        n = len(x)
        want = [0] * n if n < 5 else hdbscan(x.astype(np.float64), density.min_cluster_size(n))
        assert [got[key][i] for i in range(n)] == want, key
    assert got["d", 1] == dict.fromkeys(range(7), -1)
    summary = evaluation_clusters.set_clusters(found, keys).collect()
    assert sum(r["size"] for r in summary) == failures.count()
    assert [(r.label, r["size"], r.failures) for r in summary if r.iteration is None] == [("general_failures", 4, 4)]
    assert {r.label for r in summary if r.run_id == "c"} == {"noise_outliers"}


def test_without_any_set(failures):
    assert evaluation_clusters.cluster_sets(failures.limit(0), ["run_id"]).count() == 0
    few = evaluation_clusters.cluster_sets(failures.filter("iteration IS NULL"), ["run_id"]).collect()
    assert [r.cluster_id for r in few] == [0] * 4


def test_equal_vectors_are_noise_and_stay(spark):
    x = np.repeat(BLOBS[:1], 12, 0)
    assert labels(density.cluster_members(as_rows(spark, x))) == hdbscan(x.astype(np.float64), 5) == [-1] * 12


def test_vectors_whose_digests_meet(spark, monkeypatch):
    rows = as_rows(spark, COPIES)
    named = rows.groupBy(F.col("embedding").alias("vec")).agg(F.min("ord").alias("first"))
    want = {r.ord: r.first for r in rows.join(named, rows.embedding == named.vec).collect()}
    for digest in (density._digest, lambda v: F.xxhash64(F.floor(F.get(v, 0) * 2)), lambda v: F.lit(7).cast("long")):
        monkeypatch.setattr(density, "_digest", digest)
        got = density.by_vector(rows, "embedding", named).collect()
        assert len(got) == len(COPIES) and {r.ord: r.first for r in got} == want


def test_failures_are_computed_once(spark, failures):
    keys, seen = ["run_id", "iteration"], spark.sparkContext.accumulator(0)
    few = failures.filter("run_id IN ('c', 'd')")

    def passed(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = evaluation_clusters.cluster_sets(few.mapInArrow(passed, few.schema), keys, block_rows=16)
    summary = evaluation_clusters.set_clusters(found, keys).collect()
    assert sum(r["size"] for r in summary) == found.count() == seen.value == few.count() == 19
