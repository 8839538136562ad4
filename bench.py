"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2 timed runs after a warm one; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from gridtally.session import build_session
from gridtally.workload.catalog import QUERIES

HEADLINE = (
    "enrich_aws",
    "enrich_aws_focus",
    "enrich_azure",
    "summary_by_period",
    "top_services",
    "cost_coverage",
    "regional_report",
    "overview",
    "regions_weighted",
    "tag_coverage",
    "tag_top_other",
    "equivalences",
    "split_allocate",
    "split_by_namespace",
    "lookup_gaps",
    "latest_per_key",
)


def once(spark, name: str, sf_dir: str) -> float:
    """Seconds to plan and run a query with every result column computed."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        once(spark, name, sf_dir)
        seconds[name] = round(statistics.median(once(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, median of warm runs, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
