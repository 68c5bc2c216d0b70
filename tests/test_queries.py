import pytest
from check_oracle import compare, connect

from __spark_entry__ import entry
from toolgauge.plans.oracle import SQL
from toolgauge.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
ROWS_ONLY = {"failure_vectors", "mst_edges", "cluster_members", "failure_clusters"}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_entry(spark):
    assert {r.tool for r in entry(spark).collect()} >= {"view", "error", "refund"}


def test_every_query_has_its_sql():
    assert set(QUERIES) - set(SQL) == ROWS_ONLY
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF_DIR, name, QUERIES[name], SQL[name]) == ""


def test_failure_vectors(spark):
    rows = QUERIES["failure_vectors"](spark, SF_DIR).collect()
    failed = QUERIES["failures"](spark, SF_DIR).count()
    assert len(rows) == failed
    assert all(len(r.embedding) == 384 for r in rows)
    assert all(abs(sum(v * v for v in r.embedding) - 1) < 1e-4 for r in rows)


def test_clusters_of_the_given_vectors(spark):
    import numpy as np
    import pyarrow.parquet as pq
    from brute_hdbscan import hdbscan

    table = pq.read_table(f"{SF_DIR}/embeddings.parquet").to_pandas().sort_values("vec_id")
    want = hdbscan(np.stack(table.embedding).astype(np.float64), 5)
    rows = QUERIES["cluster_members"](spark, SF_DIR).collect()
    assert [r.cluster_id for r in sorted(rows, key=lambda r: r.ord)] == want
