"""Headline queries at one scale: one JSON line with seconds per query.

Each query is run once to warm up and then ``BENCH_RUNS`` times; the fastest
counts. Results go to the no-op sink, so every row is computed and none collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from civiq.session import build_session  # noqa: E402
from workload.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "a11_choropleth", "a9_cooccurrence", "a3_top_categories", "a2_null_counts", "a6_summary_stats", "a7_correlation",
    "a8_histogram", "a10_pivot", "a12_fill_median", "d1_exact_duplicates", "d2_keep_first", "g1_explode_tags",
    "f5_gauge_extract", "j1_spatial_join", "j3_verified_tickets", "j5_name_repair", "m2_train_test_split",
    "m3_standard_scale", "s1_csv_scan", "s2_csv_scan_inferred", "e1_ticket_etl", "e2_generic_etl", "e3_clean_tickets",
    "e4_rain_history", "e6_exploration",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        first = once(name)
        seconds[name] = round(min([once(name) for _ in range(runs)] or [first]), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
