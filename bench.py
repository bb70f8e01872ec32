"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every column and
row computed, nothing collected to the driver). Before timing, every
selected query runs once on the tiny sf0.001 tables (BENCH_WARMUP_DIR) so
JVM start-up and JIT warm-up are not charged to whichever query happens to
run first. Prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (comma list, default HEADLINE), BENCH_ALL=1
for every registered query, BENCH_REPEAT (default 1, best of N).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from idweave.session import get_session  # noqa: E402
from idweave.plans.queries import REGISTRY  # noqa: E402

HEADLINE = [
    "q_history_after_v3", "q_advance_delta_v3", "q_latest", "q_snapshot_members",
    "q_stale_after_reversion", "q_linked_history", "q_normalise_a", "q_normalise_b",
    "q_vendor_match", "q_rank_completeness", "q_match_rate_a", "q_match_rate_b",
    "q_key_diff", "q_duplicate_pairs", "q_missing_regions", "q_dedup_by_key",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    if os.environ.get("BENCH_ALL") == "1":
        names = list(REGISTRY)
    else:
        names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(app="idweave-bench", master=f"local[{cpus}]", shuffle_partitions=cpus,
                        extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")

    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if warm and os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in names:
            REGISTRY[name](spark, warm).write.format("noop").mode("overwrite").save()
    else:
        REGISTRY["q_pairs_clean"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
