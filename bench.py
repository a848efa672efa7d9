"""Time the headline queries over the given test tables; prints one JSON line.

    BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
    BENCH_CPUS     cores (default 8)
    BENCH_RUNS     timed runs per query after one warm-up; the median counts (default 3)
    BENCH_QUERIES  comma-separated names, or ``all`` (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = (
    "campaign_performance",
    "extract_profiles",
    "extract_events",
    "scd2_merge",
    "scores_procedural",
    "scores_config",
    "scores_graph",
    "segment_summary_replace",
    "segment_summary_upsert",
    "micro_segments",
    "region_distribution",
    "audit_upsert",
    "sla_breaches",
    "dependency_lists",
    "grant_links",
    "weekly_scores",
)


def main() -> None:
    from clientele.session import session
    from verification.queries import all_queries

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    known = all_queries()
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(known) if asked == "all" else asked.split(",") if asked else list(HEADLINE)
    spark = session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        known[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
