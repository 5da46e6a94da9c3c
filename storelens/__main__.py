"""Command line: the shop's jobs as ``python -m storelens ...`` (or ``spark-submit -m``-style wrappers).

    python -m storelens list
    python -m storelens run province_stats --sf /data/sf0.1 --out /shared/out/province_stats
    python -m storelens stream visitor_stats_stream --sf /data/sf0.1 --out /shared/out/visitor
    python -m storelens explain product_stats --sf /data/sf0.1
"""

from __future__ import annotations

import argparse
import sys

from storelens.plans.registry import BATCH as QUERIES
from storelens.plans.registry import STREAMS as STREAM_QUERIES
from storelens.session import build_session, clear_materialized


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="storelens")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    p.add_argument("--partitions", type=int, default=200, help="spark.sql.shuffle.partitions")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    for name in ("run", "stream", "explain"):
        s = sub.add_parser(name)
        s.add_argument("job")
        s.add_argument("--sf", required=True, help="folder with the input parquet tables")
        s.add_argument("--out", help="parquet output folder (run, stream)")
        s.add_argument("--show", type=int, default=0, help="print the first rows")
    a = p.parse_args(argv)
    if a.cmd == "list":
        print("batch: " + " ".join(sorted(QUERIES)))
        print("stream: " + " ".join(sorted(STREAM_QUERIES)))
        return 0
    spark = build_session(a.master, a.partitions, app=f"storelens-{a.job}")
    jobs = STREAM_QUERIES if a.cmd == "stream" else QUERIES
    if a.job not in jobs:
        print(f"unknown job {a.job!r}", file=sys.stderr)
        return 2
    df = jobs[a.job](spark, a.sf)
    if a.cmd == "explain":
        df.explain("formatted")
        return 0
    if a.out:
        df.write.mode("overwrite").parquet(a.out)
    if a.show:
        df.show(a.show, truncate=False)
    if not a.out and not a.show:
        df.write.format("noop").mode("overwrite").save()
    clear_materialized(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
