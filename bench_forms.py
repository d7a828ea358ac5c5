"""Direct vs rewritten forms: each question as one plain SQL statement in Spark SQL (joins
before aggregation, window over rows, COUNT DISTINCT) against the venuelens operator plan.

Prints one JSON line with the median seconds of both forms per key.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from venuelens.plans.bindings import ORACLE_SQL, QUERIES  # noqa: E402
from venuelens.session import local_session  # noqa: E402

KEYS = ["market_opportunity", "percent_rank_groups", "percent_rank_near_unique", "percent_rank_hot_group"]
TABLES = "region nation customer supplier part orders lineitem events".split()


def timed(fn, repeats):
    fn()
    out = []
    for _ in range(repeats):
        t = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t)
    return round(statistics.median(out), 3)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="venuelens-forms", memory="16g")
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    res = {}
    for k in KEYS:
        direct = ORACLE_SQL[k]  # plain enough to run in both dialects
        res[k] = {
            "direct_sql": timed(lambda: spark.sql(direct).write.format("noop").mode("overwrite").save(), repeats),
            "venuelens": timed(lambda: QUERIES[k](spark, sf_dir).write.format("noop").mode("overwrite").save(), repeats),
        }
    print(json.dumps({"sf_dir": sf_dir, "repeats": repeats, "forms": res}))
    spark.stop()


if __name__ == "__main__":
    main()
