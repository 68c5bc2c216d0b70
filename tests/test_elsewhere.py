"""Tasks must not need the package on their path: run from a folder that lacks it."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from toolgauge.operators import density
from toolgauge.plans import inputs
from toolgauge.session import local_session
spark = local_session(2)
rows = inputs.vector_failures(spark, "/root/testdata/sf0.001").drop("cluster_id")
print("clusters", density.failure_clusters(density.cluster_members(rows, block_rows=200)).count())
"""


def test_runs_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith("PYSPARK")}
    env.pop("PYTHONPATH", None)
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240,
    )
    assert "clusters 3" in done.stdout, done.stderr[-3000:]
