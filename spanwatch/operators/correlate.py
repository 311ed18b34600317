"""Pairing starts with ends, and the three classes that result."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.operators.matching import (
    KEY_HASH,
    complete,
    expand_matches,
    join_key_counts,
    key_counts,
    keyed,
    keyed_or_spread,
    with_matches,
    without_match,
)
from spanwatch.operators.sides import ends, starts
from spanwatch.schema import (
    ACTIVITY_END,
    ACTIVITY_START,
    COMMON_COLUMNS,
    END_COLUMNS,
    END_KEYS,
    FINISHED_COLUMNS,
    IP_CHECK_KEY,
    PAIR_KEYS,
    START_COLUMNS,
    START_KEYS,
    TRACE_KEY,
    prefixed,
)


def finished_columns() -> list:
    """End columns back under their plain names."""
    return (
        [F.col(prefixed("e", c)).alias(c) for c in COMMON_COLUMNS]
        + [F.col("durationInMillis"), F.col(prefixed("e", TRACE_KEY)).alias(TRACE_KEY)]
        + [F.col(IP_CHECK_KEY)]
    )


def correlated_events(events: DataFrame) -> DataFrame:
    """All starts and ends, each once, with the number of ``matches`` it has on the other side
    and the time of the latest of them: what ``correlated`` says in m times n rows, in m + n."""
    last = {"_lastStart": F.max(F.when(F.col("eventType") == ACTIVITY_START, F.col("timestamp"))),
            "_lastEnd": F.max(F.when(F.col("eventType") == ACTIVITY_END, F.col("timestamp")))}
    rows = classify(events, **last)
    partner = F.when(F.col("eventType") == ACTIVITY_START, F.col("_lastEnd")).otherwise(F.col("_lastStart"))
    return rows.withColumn("partnerTimestamp", partner).drop(*last)


def correlated(events: DataFrame) -> DataFrame:
    """Full outer join of starts and ends: one row per pair, open start and orphan end.

    A key with m starts and n ends has m times n rows; ``correlated_events`` has m + n.

    Adaptive execution cannot split a skewed full outer join. So the pairs come from
    an inner join, which it can split on either side, and the unmatched rows from
    anti joins that reuse the inner join's shuffles. Null keys are not shuffled.
    """
    s, e = starts(events), ends(events)
    keyed_s, keyed_e = keyed(s, START_KEYS), keyed(e, END_KEYS)
    same_key = reduce(and_, (F.col(a) == F.col(b) for a, b in zip(START_KEYS, END_KEYS)))
    pairs = keyed_s.join(
        keyed_e.withColumnRenamed(KEY_HASH, "_hash"), same_key & (F.col(KEY_HASH) == F.col("_hash"))
    ).select(*START_COLUMNS, *END_COLUMNS)
    here = F.count(F.lit(1))
    unmatched = [
        join_key_counts(keyed_s, START_KEYS, key_counts(e, END_KEYS, _n=here), "left_anti"),
        join_key_counts(keyed_e, END_KEYS, key_counts(s, START_KEYS, _n=here), "left_anti"),
        s.where(~complete(START_KEYS)),
        e.where(~complete(END_KEYS)),
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), unmatched, pairs)


def starts_without_end(events: DataFrame) -> DataFrame:
    return without_match(starts(events), START_KEYS, ends(events), END_KEYS)


def ends_without_start(events: DataFrame) -> DataFrame:
    return without_match(ends(events), END_KEYS, starts(events), START_KEYS)


def finished(events: DataFrame) -> DataFrame:
    """Finished activities: each end that has a start, once, and its number of starts."""
    rows = with_matches(ends(events), END_KEYS, starts(events), START_KEYS)
    return rows.select(*finished_columns(), "matches")


def finished_events(events: DataFrame) -> DataFrame:
    """Finished activities with one row per pair of start and end."""
    return expand_matches(finished(events))


def classify(events: DataFrame, **totals) -> DataFrame:
    """All starts and ends, each with the number of ``matches`` it has on the other side.

    One pass over the full rows serves all three classes; use ``finished_side``,
    ``open_side`` and ``orphan_side`` on the stored result. ``totals`` are further
    aggregates of the key's events, added as columns.
    """
    is_start = F.col("eventType") == ACTIVITY_START
    activities = events.where(F.col("eventType").isin(ACTIVITY_START, ACTIVITY_END))
    activities = activities.select(
        *COMMON_COLUMNS,
        "durationInMillis",
        F.col("payload")[TRACE_KEY].alias(TRACE_KEY),
        F.col("payload")[IP_CHECK_KEY].alias(IP_CHECK_KEY),
    )
    counts = key_counts(
        activities, PAIR_KEYS, _starts=F.count_if(is_start), _ends=F.count_if(~is_start), **totals
    )
    rows = join_key_counts(keyed_or_spread(activities, PAIR_KEYS), PAIR_KEYS, counts, "left_outer")
    matches = F.coalesce(F.when(is_start, F.col("_ends")).otherwise(F.col("_starts")), F.lit(0))
    return rows.withColumn("matches", matches.cast("bigint")).drop("_starts", "_ends")


def finished_side(classified: DataFrame) -> DataFrame:
    is_finished = (F.col("eventType") == ACTIVITY_END) & (F.col("matches") > 0)
    return classified.where(is_finished).select(*FINISHED_COLUMNS, "matches")


def open_side(classified: DataFrame) -> DataFrame:
    is_open = (F.col("eventType") == ACTIVITY_START) & (F.col("matches") == 0)
    columns = [F.col(c).alias(prefixed("s", c)) for c in [*COMMON_COLUMNS, TRACE_KEY]]
    return classified.where(is_open).select(*columns)


def orphan_side(classified: DataFrame) -> DataFrame:
    is_orphan = (F.col("eventType") == ACTIVITY_END) & (F.col("matches") == 0)
    columns = [F.col(c).alias(prefixed("e", c)) for c in [*COMMON_COLUMNS, TRACE_KEY]]
    return classified.where(is_orphan).select(*columns, "durationInMillis", IP_CHECK_KEY).select(
        *END_COLUMNS
    )
