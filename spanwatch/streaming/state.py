"""What a batch adds to the stored state of its keys, so that results depend on no batch cut."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.functions import document_id, kpi_text
from spanwatch.operators.matching import complete, join_key_counts, key_counts, keyed, keyed_or_spread
from spanwatch.schema import (
    ACTIVITY_END,
    ACTIVITY_START,
    COMMON_COLUMNS,
    EVENT_SCHEMA,
    IP_CHECK_KEY,
    PAIR_KEYS,
    TRACE_KEY,
)
from spanwatch.sources.delta import DeltaLog

ACTIVITY_COLUMNS = [*COMMON_COLUMNS, "durationInMillis", TRACE_KEY, IP_CHECK_KEY]
ACTIVITY_SCHEMA = T.StructType(
    [EVENT_SCHEMA[c] for c in [*COMMON_COLUMNS, "durationInMillis"]]
    + [T.StructField(c, T.StringType()) for c in (TRACE_KEY, IP_CHECK_KEY)]
)
NAME = "businessProcessActivityName"
SUMS = ("starts", "ends", "bad")
LASTS = ("lastStart", "lastEnd")
# One key's numbers after a batch and, with a 0 to the name, before it.
KEY_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in PAIR_KEYS]
    + [T.StructField(c + o, T.LongType()) for c in ("starts", "ends") for o in ("", "0")]
)
# Per key and activity name: starts, ends and violating ends, and the latest times. They add up over the
# batches. A key with starts and ends is paired, and its stored rows no longer count.
MARK_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in [*PAIR_KEYS, NAME]]
    + [T.StructField(c, T.LongType()) for c in SUMS]
    + [T.StructField(c, T.TimestampType()) for c in LASTS]
)
PAIRED, WAS_PAIRED = "starts > 0 AND ends > 0", "starts0 > 0 AND ends0 > 0"
WIDE = "decimal(19,0)"


def is_start() -> Column:
    return F.col("eventType") == ACTIVITY_START


def is_end() -> Column:
    return F.col("eventType") == ACTIVITY_END


def activities(events: DataFrame) -> DataFrame:
    """Starts and ends with the two payload values as columns."""
    kinds = F.col("eventType").isin(ACTIVITY_START, ACTIVITY_END)
    return events.where(kinds).select(
        *COMMON_COLUMNS, "durationInMillis",
        F.col("payload")[TRACE_KEY].alias(TRACE_KEY), F.col("payload")[IP_CHECK_KEY].alias(IP_CHECK_KEY),
    )


def key_marks(acts: DataFrame, threshold: int) -> DataFrame:
    """One row per key and activity name, summed up by the reading tasks first."""
    late = is_end() & (kpi_text("durationInMillis", threshold) == "NOK")
    return acts.where(complete(PAIR_KEYS)).groupBy(*PAIR_KEYS, NAME).agg(
        F.count_if(is_start()).alias("starts"), F.count_if(is_end()).alias("ends"), F.count_if(late).alias("bad"),
        F.max(F.when(is_start(), F.col("timestamp"))).alias("lastStart"),
        F.max(F.when(is_end(), F.col("timestamp"))).alias("lastEnd"),
    )


def added_up(marks: DataFrame, keys: list[str]) -> DataFrame:
    """Marks that came one after the other as one row per ``keys``."""
    return marks.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMS], *[F.max(c).alias(c) for c in LASTS])


def marks_after(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Per key and activity name: numbers after the batch and, with a 0 to the name, before it."""
    both = fresh.select(*PAIR_KEYS, NAME, *SUMS, *[F.lit(0).cast("bigint").alias(f"{c}0") for c in SUMS]).unionByName(
        stored.select(*PAIR_KEYS, NAME, *SUMS, *[F.col(c).alias(f"{c}0") for c in SUMS])
    )
    return both.groupBy(*PAIR_KEYS, NAME).agg(*[F.sum(c + o).alias(c + o) for c in SUMS for o in ("", "0")])


def key_totals(marks: DataFrame) -> DataFrame:
    """One row per key of ``marks_after``."""
    return marks.groupBy(*PAIR_KEYS).agg(*[F.sum(c + o).alias(c + o) for c in ("starts", "ends") for o in ("", "0")])


def with_totals(acts: DataFrame, totals: DataFrame) -> DataFrame:
    """The batch's keyed rows, each with its key's totals; a join that cannot multiply rows and can be split."""
    counts = totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(PAIR_KEYS)], "starts", "ends", "starts0", "ends0")
    return join_key_counts(keyed(acts, PAIR_KEYS), PAIR_KEYS, counts, "inner")


def newly_finished(rows: DataFrame, flipped: DataFrame) -> DataFrame:
    """Ends that have a start now: the batch's own (``with_totals``), and stored ones whose first start has come."""
    columns = [*ACTIVITY_COLUMNS, F.col("starts").alias("matches")]
    own = rows.where(is_end() & F.expr(PAIRED)).select(*columns)
    return own.unionByName(flipped.where(is_end() & F.expr("starts0 = 0")).select(*columns))


def _pairs(starts: str, ends: str) -> Column:
    return F.col(starts).cast(WIDE) * F.col(ends).cast(WIDE)


def new_violations(marks: DataFrame, totals: DataFrame) -> DataFrame:
    """How many violating pairs the batch adds per process, activity name and document id.

    Starts times violating ends after the batch, less the same before it: summed over the
    batches, that is the number of violating pairs, however the events were cut.
    """
    names = marks.where("bad > 0").select(*PAIR_KEYS, NAME, "bad", "bad0")
    more = (_pairs("starts", "bad") - _pairs("starts0", "bad0")).cast("decimal(38,0)")
    return (
        names.join(totals.select(*PAIR_KEYS, "starts", "starts0"), PAIR_KEYS)
        .select(
            "businessProcessName", NAME, document_id("businessProcessName", NAME, TRACE_KEY).alias("id"), more.alias("n")
        )
        .groupBy("businessProcessName", NAME, "id")
        .agg(F.sum("n").cast("decimal(38,0)").alias("n")).where("n > 0")
    )


def new_trace_counts(totals: DataFrame, unkeyed: DataFrame) -> DataFrame:
    """By how much the batch changes the numbers of finished pairs, open starts and orphan ends per
    process and trace; ``unkeyed`` rows are open or orphan for good."""
    change = {
        "finished": _pairs("starts", "ends") - _pairs("starts0", "ends0"),
        "open": F.when(F.col("ends") == 0, F.col("starts")).otherwise(0) - F.when(F.col("ends0") == 0, F.col("starts0")).otherwise(0),
        "orphan": F.when(F.col("starts") == 0, F.col("ends")).otherwise(0) - F.when(F.col("starts0") == 0, F.col("ends0")).otherwise(0),
    }
    group = ["businessProcessName", TRACE_KEY]
    kinds = {"finished": F.lit(0), "open": is_start().cast("int"), "orphan": is_end().cast("int")}
    rows = totals.select(*group, *[c.cast("decimal(38,0)").alias(k) for k, c in change.items()]).unionByName(
        unkeyed.select(*group, *[c.cast("decimal(38,0)").alias(k) for k, c in kinds.items()])
    )
    summed = rows.groupBy(*group).agg(*[F.sum(k).cast("decimal(38,0)").alias(k) for k in change])
    return summed.where(" OR ".join(f"{k} <> 0" for k in change))


def paired_keys(marks: DataFrame) -> DataFrame:
    """Keys that have starts and ends, of all marks."""
    return added_up(marks, PAIR_KEYS).where(PAIRED)


def unmatched_rows(log: DeltaLog, before: int, epoch: int | None = None) -> DataFrame:
    """Open starts and orphan ends when batch ``before`` begins: stored rows of keys that are not paired."""
    counts = key_counts(paired_keys(log.marks(before, epoch=epoch)), PAIR_KEYS, _n=F.count(F.lit(1)))
    return join_key_counts(keyed_or_spread(log.rows(before, epoch=epoch), PAIR_KEYS), PAIR_KEYS, counts, "left_anti")


def next_base(log: DeltaLog, batch_id: int, threshold: int, stale: Column | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows and marks to start the next epoch from, and rows for which ``stale`` holds, which both leave out."""
    epoch = log.epoch(batch_id)
    alive, known = unmatched_rows(log, batch_id + 1, epoch), log.marks(batch_id + 1, epoch=epoch)
    marks = added_up(known, [*PAIR_KEYS, NAME])
    if stale is None:
        return alive, marks, alive.where("false")
    gone = F.coalesce(stale, F.lit(False))
    paired = marks.join(paired_keys(known).select(*PAIR_KEYS), PAIR_KEYS, "left_semi")
    return alive.where(~gone), paired.unionByName(key_marks(alive.where(~gone), threshold)), alive.where(gone)
