"""Run the whole posting flow: ``spark-submit scripts/run_flow.py --pages P --out O``.

Input is a pages table (Parquet with ``page_id, url, html``) or an already
extracted posting table (CSV with the 11 posting columns).  Every stage writes
under ``--out``.  The session comes from spark-submit; ``--cores`` applies
``session.cluster_conf`` on top of it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from posting_analytics.plans import posting_flow  # noqa: E402
from posting_analytics.session import cluster_conf  # noqa: E402
from posting_analytics.sources import files  # noqa: E402


def main(argv=None) -> dict:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--pages", help="Parquet table of pages (page_id, url, html)")
    src.add_argument("--postings-csv", help="CSV of extracted postings (11 columns, header)")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--run-date", default=dt.date.today().isoformat(), help="crawl date, yyyy-MM-dd")
    ap.add_argument("--k", type=int, default=4, help="number of k-means clusters")
    ap.add_argument("--cores", type=int, help="total executor cores: apply cluster_conf")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName("posting-flow")
    for key, value in (cluster_conf(args.cores) if args.cores else {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    run_ts = dt.datetime.combine(dt.date.fromisoformat(args.run_date), dt.time())
    if args.pages:
        paths = posting_flow.run(spark, args.out, pages=spark.read.parquet(args.pages),
                                 run_date=args.run_date, run_ts=run_ts, k=args.k)
    else:
        raw = files.read_csv(spark, args.postings_csv, files.POSTING_SCHEMA)
        paths = posting_flow.run(spark, args.out, raw=raw, run_ts=run_ts, k=args.k)
    print(json.dumps(paths, indent=1))
    return paths


if __name__ == "__main__":
    main()
