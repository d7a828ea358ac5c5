"""Benchmark: wall time of the registered queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query seconds), "unit", "queries", "sf", ...}.
Each query runs once to warm up (JIT, file listing), then is timed over ``BENCH_REPEATS`` runs
(median). A query's time covers planning and executing the full result (written to a no-op
sink), not a collect to the driver.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from venuelens.plans.bindings import QUERIES  # noqa: E402
from venuelens.session import local_session  # noqa: E402

# Headline keys: the ten questions, their derived frames and the curation.
HEADLINE = [
    "market_opportunity", "daypart_leaders", "category_rating", "price_tier_rating", "category_leaders",
    "reviewer_influence", "yoy_change", "traffic_vs_rating", "rolling_gap", "entity_segments",
    "curate", "packed_filter", "expand_visits", "percent_rank_groups", "load_insert_absent",
]


def run(spark, key, sf_dir):
    t = time.perf_counter()
    QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "5"))
    keys = os.environ.get("BENCH_KEYS")
    keys = sorted(QUERIES) if keys == "all" else (keys.split(",") if keys else HEADLINE)
    spark = local_session(cpus, app="venuelens-bench", memory=os.environ.get("BENCH_MEMORY", "16g"))
    times, errors = {}, {}
    for k in keys:
        try:
            run(spark, k, sf_dir)
            times[k] = round(statistics.median(run(spark, k, sf_dir) for _ in range(repeats)), 3)
        except Exception as e:  # a failing key is reported, the others are still measured
            errors[k] = f"{type(e).__name__}: {str(e)[:300]}"
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "repeats": repeats,
                **({"errors": errors} if errors else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
