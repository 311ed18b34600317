"""What the Bloom filter spares: bytes shuffled to look 1 % of the keys up among stored rows, with and without.

Usage: python scripts/lookup_trial.py [STORED_ROWS]. Reads Spark's event log, which it writes to a new folder.
"""

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from pyspark.sql import functions as F  # noqa: E402

from spanwatch.schema import PAIR_KEYS  # noqa: E402
from spanwatch.session import build_session  # noqa: E402
from spanwatch.sources import DeltaLog  # noqa: E402
from spanwatch.streaming.state import ACTIVITY_SCHEMA, KEY_SCHEMA, MARK_SCHEMA  # noqa: E402


def shaped(ids, schema):
    values = {
        "businessProcessName": F.concat(F.lit("process-"), F.col("id") % 5), "businessProcessActivityId": F.concat(F.lit("activity-"), F.col("id") % 3),
        "spp_trace_wf_id": F.sha2(F.col("id").cast("string"), 256), "eventType": F.lit("ACTIVITY_END"),
        "starts": F.lit(0), "starts0": F.lit(0), "ends": F.lit(1), "timestamp": F.timestamp_seconds("id"),
    }
    return ids.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def main():
    stored = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
    root = tempfile.mkdtemp(prefix="lookup-")
    spark = build_session(
        "lookup", "local[8]", spark__sql__shuffle__partitions="16", spark__sql__autoBroadcastJoinThreshold="-1", spark__driver__memory="6g",
        spark__eventLog__enabled="true", spark__eventLog__dir=f"file://{root}", spark__eventLog__compress="false", spark__eventLog__rolling__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    log = DeltaLog(spark, f"{root}/log", ACTIVITY_SCHEMA, MARK_SCHEMA, PAIR_KEYS, 2)
    log.write_base(1, shaped(spark.range(stored), ACTIVITY_SCHEMA), shaped(spark.range(stored // 100), MARK_SCHEMA))
    shaped(spark.range(0, stored, 100), KEY_SCHEMA).write.parquet(f"{root}/paired")
    for name, threshold in (("without", "1000t"), ("with", "1b")):
        spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", threshold)
        spark.sparkContext.setJobDescription(name)
        flips = spark.read.schema(KEY_SCHEMA).parquet(f"{root}/paired").where("starts0 = 0")
        log.rows(2, flips, "eventType = 'ACTIVITY_END'").write.format("noop").mode("overwrite").save()
    spark.stop()
    jobs, totals = {}, {"without": [0, 0], "with": [0, 0]}
    for line in open(max(glob.glob(f"{root}/local-*"))):
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            jobs.update({s: event["Properties"].get("spark.job.description") for s in event["Stage IDs"]})
        elif event["Event"] == "SparkListenerTaskEnd" and jobs.get(event["Stage ID"]) in totals:
            metrics, total = event["Task Metrics"], totals[jobs[event["Stage ID"]]]
            total[0] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"]
            total[1] += metrics["Executor CPU Time"]
    for name, (size, cpu) in totals.items():
        print(f"{name} the filter: {size / 1e6:.1f} MB shuffled, {cpu / 1e9:.1f} CPU seconds")


if __name__ == "__main__":
    main()
