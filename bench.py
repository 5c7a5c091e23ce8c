"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) holds the tables, ``BENCH_CPUS`` (default 8) is
the number of local cores. All queries run once to warm up, then each runs three times;
the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import all_queries  # noqa: E402
from shoptrail.session import build_session  # noqa: E402

HEADLINE = [
    "session_length_ratios",
    "session_sample",
    "category_top10",
    "category_top10_sessions",
    "page_flow_rates",
    "area_top3_products",
    "ad_blacklist",
    "ad_province_top3",
    "ad_minute_trend",
    "ad_last_hour",
    "session_rollup",
    "action_gaps",
    "ad_stream_blacklist",
]


def seconds(run, spark, folder) -> float:
    start = time.perf_counter()
    run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus)
    queries = all_queries()
    for name in HEADLINE:
        seconds(queries[name], spark, folder)
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(seconds(queries[name], spark, folder) for _ in range(3)), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
