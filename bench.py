"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the cores. Each query runs
once to warm up and then three times; the fastest run counts. Results go to a sink
that reads every row and column and stores nothing.
"""

import json
import os
import time

from spanwatch.plans import QUERIES
from spanwatch.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))
HEADLINE = [
    "q_parse_events",
    "q_correlated",
    "q_classified",
    "q_finished_events",
    "q_starts_without_end",
    "q_kpi_status",
    "q_documents_latest",
    "q_daily_documents",
    "q_finished_per_trace",
    "q_alarms",
    "q_resolve_pending",
    "q_phases",
    "q_phases_latest",
    "q_stream_correlated",
    "q_stream_documents",
]


def run(spark, name):
    begin = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main():
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        streaming = name.startswith("q_stream")
        run(spark, name)
        times[name] = round(min(run(spark, name) for _ in range(1 if streaming else REPEATS)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
