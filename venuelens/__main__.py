"""Command line: ``python -m venuelens curate|answer ...`` (spark-submit works the same way).

    curate --raw-dir RAW --out OUT       raw JSON lines (business, review, user, checkin, tip
                                         sub-folders or files) -> curated parquet layers
    load --curated OUT --targets TGT     the five loads (replace / insert-if-absent) + reconcile
    answer --curated OUT --results RES   every question over the curated layers -> parquet
"""

from __future__ import annotations

import argparse
import os
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from .plans.curate import CurationParams, run_curation
from .plans.load import load_curated
from .plans.views import answer_all, file_views, table_views
from .sources.files import write_layer


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="venuelens")
    sub = ap.add_subparsers(dest="cmd", required=True)
    c = sub.add_parser("curate")
    c.add_argument("--raw-dir", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--year-min", type=int, default=2018)
    c.add_argument("--year-max", type=int, default=2021)
    c.add_argument("--user-fraction", type=float, default=0.40)
    c.add_argument("--review-fraction", type=float, default=0.20)
    c.add_argument("--seed", type=int, default=42)
    c.add_argument("--buckets", type=int, default=None,
                   help="also write the venues and the fact aggregates as tables bucketed by business_id "
                        "(needs a persistent catalog to be seen by later runs)")
    c.add_argument("--table-prefix", default="curated")
    ld = sub.add_parser("load")
    ld.add_argument("--curated", required=True)
    ld.add_argument("--targets", required=True)
    a = sub.add_parser("answer")
    a.add_argument("--curated", required=True)
    a.add_argument("--results", required=True)
    a.add_argument("--no-segments", action="store_true")
    a.add_argument("--table-prefix", default=None, help="read the bucketed tables of a curate --buckets run")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"venuelens-{args.cmd}").getOrCreate()
    if args.cmd == "curate":
        p = CurationParams(args.year_min, args.year_max, args.user_fraction, args.review_fraction, args.seed)
        raw = {n: os.path.join(args.raw_dir, n) for n in ("business", "review", "user", "checkin", "tip")}
        run_curation(spark, raw, args.out, p, buckets=args.buckets, table_prefix=args.table_prefix).show(truncate=False)
    elif args.cmd == "load":
        load_curated(spark, args.curated, args.targets).show(truncate=False)
    else:
        views = (
            table_views(spark, args.curated, args.table_prefix) if args.table_prefix else file_views(spark, args.curated)
        )
        answers = answer_all(views, segments=not args.no_segments)
        # independent result jobs: submit them from a few threads so the scheduler overlaps them
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(lambda kv: write_layer(kv[1], os.path.join(args.results, kv[0])), answers.items()))


if __name__ == "__main__":
    main()
