"""Time the operators on a table where one key holds a third of all rows, or on an even one.

    python scripts/skew_trial.py hot|even ROWS WORK_DIR [NAME ...]

In the hot table a third of the events carry one trace, a sixth carry none, the rest
come in pairs. In the even table all come in pairs.
WORK_DIR gets the table once and is used again by later runs. Broadcasts are off,
as they would be at a size where no side fits.
"""

import os
import sys
import time

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from pyspark.sql import functions as F  # noqa: E402

from spanwatch import operators as op  # noqa: E402
from spanwatch.operators.correlate import finished_columns  # noqa: E402
from spanwatch.schema import ACTIVITY_END, ACTIVITY_START, END_KEYS, START_KEYS  # noqa: E402
from spanwatch.session import build_session  # noqa: E402


def skewed_events(spark, rows, even):
    i = F.col("id")
    hot, unkeyed = (F.lit(False), F.lit(False)) if even else (i % 6 < 2, i % 6 == 2)
    pair = F.when(hot, F.lit("hot")).when(unkeyed, None).otherwise(F.sha1((i / 12).cast("bigint").cast("string")))
    process = F.when(hot, F.lit("process-0")).otherwise(F.concat(F.lit("process-"), (i % 7).cast("string")))
    spread = F.xxhash64(i)
    return spark.range(rows).select(
        F.lit(1).alias("version"),
        F.timestamp_micros(F.lit(1704067200000000) + i * 1000).alias("timestamp"),
        F.lit("bam_event").alias("documentType"),
        F.when((i / 6).cast("bigint") % 2 == 0, ACTIVITY_START).otherwise(ACTIVITY_END).alias("eventType"),
        F.concat(F.lit("host-"), spread.cast("string")).alias("technicalOrigin"),
        F.concat(F.lit("BO-"), (spread % 1000).cast("string")).alias("businessOrigin"),
        process.alias("businessProcessId"),
        process.alias("businessProcessName"),
        F.lit("1.0.0").alias("businessProcessVersion"),
        F.when(hot, "a").otherwise(F.concat(F.lit("a"), (i % 6).cast("string"))).alias("businessProcessActivityId"),
        F.when(spread % 2 == 0, "step").alias("businessProcessActivityName"),
        F.concat(F.lit("i-"), (i / 12).cast("bigint").cast("string")).alias("businessProcessInstanceId"),
        (F.abs(spread) % 10000).alias("durationInMillis"),
        F.create_map(F.lit("spp_trace_wf_id"), pair, F.lit("ipCheckResult"), F.lit("YES")).alias("payload"),
    )


def full_outer(events):
    """All pairs by one full outer join, for comparison; a hot key is beyond it."""
    s, e = op.starts(events), op.ends(events)
    same = [F.col(a) == F.col(b) for a, b in zip(START_KEYS, END_KEYS)]
    return s.join(e, same, "full_outer")


def ranked_full_outer(events):
    """Latest documents by way of the full outer join."""
    pairs = full_outer(events).where("sEventType IS NOT NULL AND eEventType IS NOT NULL")
    return op.latest_documents(op.documents(pairs.select(*finished_columns())))


TRIALS = {
    "starts_without_end": op.starts_without_end,
    "finished": op.finished,
    "classify": op.classify,
    "latest_documents": lambda ev: op.latest_documents(op.documents(op.finished(ev))),
    "alarms": lambda ev: op.alarms(op.documents(op.finished(ev))),
    "trace_counts": lambda ev: op.trace_counts(
        op.pair_counts(ev), "businessProcessName", "spp_trace_wf_id", weight="count"
    ),
}
EVEN_TRIALS = {
    **TRIALS,
    "correlated": op.correlated,
    "full_outer": full_outer,
    "ranked_full_outer": ranked_full_outer,
}


def main(kind, rows, work, *wanted):
    spark = build_session(
        "skew", "local[8]", spark__driver__memory="16g", spark__sql__shuffle__partitions="64",
        spark__sql__autoBroadcastJoinThreshold="-1",
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = f"{work}/{kind}-{rows}"
    if not os.path.exists(f"{path}/_SUCCESS"):
        skewed_events(spark, int(rows), kind == "even").write.mode("overwrite").parquet(path)
    events = spark.read.parquet(path)
    for name, trial in (EVEN_TRIALS if kind == "even" else TRIALS).items():
        if wanted and name not in wanted:
            continue
        df = trial(events)
        begin = time.time()
        df.write.format("noop").mode("overwrite").save()
        print(f"{name:22} {time.time() - begin:7.1f} s", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
