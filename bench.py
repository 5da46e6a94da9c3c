"""Benchmark: runs the headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line.

Each job is executed to completion with the ``noop`` sink (the whole plan runs, nothing is collected).
One warm-up pass, then ``$BENCH_REPEAT`` timed passes; the per-job figure is the median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from storelens.plans import jobs, registry  # noqa: E402
from storelens.session import build_session, clear_materialized  # noqa: E402

# Streaming chains, each run once to completion after the batch jobs; reported apart, not part of the sum.
STREAMS = ("keyword_stats_stream", "province_stats_stream")
HEADLINE = (
    "province_stats", "order_wide", "payment_wide", "product_stats", "visitor_stats", "keyword_stats",
    "keyword_actions", "new_visitor_repair", "unique_visit", "user_jump_1h", "log_parse", "route_changes",
    "dim_upsert", "document_keywords", "token_counts",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"],
                 "spark.eventLog.compress": "false"}
    spark = build_session(f"local[{cpus}]", partitions=cpus, app="storelens-bench", extra=extra)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        jobs.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for n in names:  # warm-up: JIT, file listing caches
        run(n)
    times = {n: [] for n in names}
    for _ in range(repeat):
        for n in names:
            times[n].append(run(n))
    per = {n: round(statistics.median(v), 3) for n, v in times.items()}
    streams = {}
    for n in [x for x in os.environ.get("BENCH_STREAMS", ",".join(STREAMS)).split(",") if x]:
        t0 = time.perf_counter()
        registry.ALL[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        streams[n] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_median_query_sec", "value": round(sum(per.values()), 3), "unit": "sec",
                      "queries": per, "streams": streams, "sf": sf, "cpus": cpus, "repeat": repeat}))
    clear_materialized(spark)
    spark.stop()


if __name__ == "__main__":
    main()
