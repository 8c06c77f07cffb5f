"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR   folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default: all)
BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
BENCH_QUERIES  comma-separated names, or "all" (default: the headline list)
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from stratavault.catalog.registry import all_queries  # noqa: E402
from stratavault.catalog.stream_queries import RENDERED  # noqa: E402
from stratavault.session import build_session, release  # noqa: E402

HEADLINE = [
    "hub_composite", "link_equi", "link_hash", "sat_measures", "bdv_revenue", "mart_fact", "report_core", "upsert_by_key",
    "sat_latest_per_key", "profile_columns", "typed_cast", "landing_clean", "stream_master_items", "stream_movement_flatten",
    "stream_order_flatten", "stream_bad_messages", "pivot_sum", "unpivot", "deduplicate", "union_relations", "column_values_topk",
    "dq_equality", "dq_relationships_where", "dq_mutually_exclusive_ranges", "dq_sequential_values", "dq_summary", "file_change_class",
    "publish_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    asked = os.environ.get("BENCH_QUERIES", "")
    found = all_queries()
    names = list(found) if asked == "all" else asked.split(",") if asked else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-", dir="/tmp")})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    every: dict[str, list[float]] = {}

    def timed(make) -> list[float]:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            make(spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(round(time.perf_counter() - started, 3))
            release(spark)
        return taken

    for name in names:
        every[name] = timed(found[name].run)
        times[name] = round(statistics.median(every[name][1:] or every[name]), 3)
    rendering = {name: round(statistics.median(timed(make)[1:]), 3) for name, make in RENDERED.items() if name in names and runs}
    spark.stop()
    print(json.dumps({"metric": "headline queries, sum of medians", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus), "runs": every,
                      "rendering_of_messages": rendering, "machine": {"cores": os.cpu_count(), "load": os.getloadavg(), "python": platform.python_version()}}))


if __name__ == "__main__":
    main()
