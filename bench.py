"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run to completion with a no-op write (every row computed, no
driver transfer). Times are wall seconds per query including the fits the
query performs (statistics passes, model training, search).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lathe.plans.queries import QUERIES  # noqa: E402
from lathe.session import local_session  # noqa: E402

HEADLINE = [
    "features_base",
    "prep_train",
    "prep_test",
    "regression_metrics",
    "cv_results_ranked",
    "kfold_ols",
    "fit_ols_predict",
    "fit_forest_predict",
    "grid_search_forest",
    "score_many_models",
    "pipeline_full",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2 if cpus.isdigit() else 16, app="lathe-bench")
    # untimed warm-up on another scale: JVM JIT, code generation and the Python
    # workers (all one-off per session), but no table that a timed query reads
    from lathe.plans.flows import flagship

    other = "/root/testdata/sf0.001" if sf_dir.rstrip("/").endswith("sf0.01") else "/root/testdata/sf0.01"
    flagship(spark, os.environ.get("BENCH_WARMUP_DIR", other)).collect()
    times = {}
    for name in names:
        spark.catalog.clearCache()  # no query is served from a table that one before it cached
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
