"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up run, then the median of ``$BENCH_REPS``
(default 3) timed runs.  Each run executes the full plan into the ``noop``
sink (no driver collect).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from vetline import session  # noqa: E402
from vetline.plans.catalog import QUERIES  # noqa: E402

HEADLINE = ["overall_stats", "channel_stats", "list_messages", "recent_matches", "parsed_answers",
            "rule_scores", "backfill_scan", "seen_upsert", "dispositions", "triage_end_to_end",
            "stream_triage"]


def run_once(spark, name, sf_dir):
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = session.build(master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    out = {}
    for name in names:
        run_once(spark, name, sf_dir)
        out[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    try:
        sf = float(sf)
    except ValueError:
        pass
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": sf}))


if __name__ == "__main__":
    main()
