"""Pairing on unbounded streams, with the open side kept as join state."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spanwatch.operators.matching import complete
from spanwatch.operators.phases import phases
from spanwatch.operators.sides import ends, starts
from spanwatch.schema import (
    ACTIVITY_END,
    ACTIVITY_START,
    END_COLUMNS,
    END_KEYS,
    PAIR_KEYS,
    START_COLUMNS,
    START_KEYS,
    TRACE_KEY,
)
from spanwatch.sources.pending import KeyedLog


def stream_correlated(events: DataFrame, delay: str = "1 hour", max_gap: str = "7 days") -> DataFrame:
    """Full outer join of the starts and ends of a stream, matching in either order of arrival.

    For streams whose events come within ``delay`` and whose pairs lie within ``max_gap``: later
    rows are dropped, wider pairs are not found, a key's rows are state of one task, and m starts
    and n ends give m times n rows. ``stream_key_totals`` and the correlation job have none of
    these limits.

    Matches come out at once; an open start or orphan end comes out when the
    watermark (``delay`` behind the newest event) has passed it by ``max_gap``, which
    also frees its state. Events with a null key match nothing, so they pass by the
    join and come out at once; they must not reach it, as a streaming outer join
    would match null with null. They are read without a watermark since a branch
    that may never see a row would hold the watermark of all others back.
    """
    marked = events.withWatermark("timestamp", delay)
    s = starts(marked).where(complete(START_KEYS))
    e = ends(marked).where(complete(END_KEYS))
    same_key = reduce(and_, (F.col(a) == F.col(b) for a, b in zip(START_KEYS, END_KEYS)))
    gap = F.expr(f"INTERVAL {max_gap}")
    in_reach = F.col("eTimestamp").between(F.col("sTimestamp") - gap, F.col("sTimestamp") + gap)
    joined = s.join(e, same_key & in_reach, "full_outer").select(*START_COLUMNS, *END_COLUMNS)
    open_starts = starts(events).where(~complete(START_KEYS))
    orphan_ends = ends(events).where(~complete(END_KEYS))
    return joined.unionByName(open_starts, allowMissingColumns=True).unionByName(
        orphan_ends, allowMissingColumns=True
    )


def stream_key_totals(events: DataFrame) -> DataFrame:
    """Starts, ends and their latest times per key of a stream, for the ``update`` output mode.

    The state is one row per key, whatever the number of its events: each task sums its share of
    a batch up before the shuffle, so a hot key is one row per task. There is no watermark:
    no event is too late, and starts and ends match however far apart. The source is read and
    parsed once. Null keys match nothing and are left out.
    """
    start, end = F.col("eventType") == ACTIVITY_START, F.col("eventType") == ACTIVITY_END
    keys = [F.col(c) for c in PAIR_KEYS[:2]] + [F.col("payload")[TRACE_KEY].alias(TRACE_KEY)]
    rows = events.where(start | end).select(*keys, "eventType", "timestamp").where(complete(PAIR_KEYS))
    return rows.groupBy(*PAIR_KEYS).agg(
        F.count_if(start).alias("starts"),
        F.count_if(end).alias("ends"),
        F.max(F.when(start, F.col("timestamp"))).alias("lastStart"),
        F.max(F.when(end, F.col("timestamp"))).alias("lastEnd"),
    )


KEY_TOTALS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in PAIR_KEYS]
    + [T.StructField(c, T.LongType()) for c in ("starts", "ends")]
    + [T.StructField(c, T.TimestampType()) for c in ("lastStart", "lastEnd")]
)


def run_key_totals(events: DataFrame, root: str, checkpoint: str, trigger: str | None = "60 seconds") -> StreamingQuery:
    """Start a job that keeps the totals of all keys in a ``KeyedLog`` below ``root``: a batch
    writes the keys that it changed. With ``trigger`` None it takes what is there and ends."""

    def write(changed: DataFrame, batch_id: int) -> None:
        log = KeyedLog(changed.sparkSession, root, KEY_TOTALS_SCHEMA, PAIR_KEYS)
        log.write(batch_id, changed)
        log.close_epoch(batch_id)

    writer = (
        stream_key_totals(events).writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()


def stream_phases(events: DataFrame, rules: DataFrame, delay: str = "1 hour",
                  max_gap: str = "7 days") -> DataFrame:
    """Phases across batches: events of one instance at most ``max_gap`` apart."""
    return phases(events.withWatermark("timestamp", delay), rules, within=max_gap)
