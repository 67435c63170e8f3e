"""Time the headline queries; prints one JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (default 3, after one warm-up).  ``python bench.py NAME ...`` times the
named queries only.  Every result is computed in full and thrown away."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from barlake.session import build_session
from verification.queries import QUERIES

HEADLINE = (
    "clean_bars",
    "clean_supplier_bars",
    "clean_and_adjust",
    "research_universe_view",
    "research_universe",
    "calendar_align",
    "st_interval_join",
    "adjust_qfq",
    "outlier_mad",
    "winsorize",
    "source_audit",
    "quality_report",
    "dedup_first",
    "source_priority_pick",
    "cross_section",
    "run_log_fold",
    "src_tencent_bars",
    "upsert_bars_partial",
    "incremental_merge",
    "stream_upsert_bars",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
    }
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(repeat)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/"))
    print(json.dumps({"metric": "total of median query times", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()
