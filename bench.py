"""Time the headline queries: one JSON line with seconds per query.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the scale.
Every query writes all of its rows to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import time

from toolgauge.plans.queries import QUERIES
from toolgauge.session import local_session

HEADLINE = (
    "scan_examples tool_catalog datagen_prompts ingest_responses patch_rows split_examples"
    " score_calls per_tool_accuracy tool_history iteration_summary failure_text patch_prompts"
    " core_distances failure_clusters"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "toolgauge-bench")
    # Start JVM and Python workers before the clock does.
    QUERIES["per_tool_accuracy"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.range(8).mapInPandas(lambda batches: batches, "id long").count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
