"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries",
"sf"}. Each query is built and fully executed (``noop`` sink, no driver
collect) three times after a warm-up on the smallest tables; the median counts.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "annotate_full",
    "direct_pairs",
    "connected_pairs",
    "org_counts",
    "org_adj_profile",
    "org_sentences",
    "group_counts_sorted",
    "org_totals",
    "adjective_report",
    "similar_topk",
    "mutual_nearest",
    "json_error_rows",
    "value_count_sorted",
    "w2v_synonyms_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from lexispark.session import get_session
    from lexispark.plans.queries import REGISTRY

    spark = get_session(f"local[{cpus}]", app="lexispark-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})

    def run(name: str, d: str) -> float:
        t = time.time()
        REGISTRY[name](spark, d).write.format("noop").mode("overwrite").save()
        return time.time() - t

    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm):
        for n in ("org_adj_profile", "similar_topk"):
            run(n, warm)
    times = {n: round(statistics.median(run(n, sf_dir) for _ in range(3)), 3) for n in names}
    m = re.search(r"sf([0-9.]+)", sf_dir.rstrip("/"))
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
