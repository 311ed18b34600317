"""The start side and the end side of the event record."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanwatch.schema import (
    ACTIVITY_END,
    ACTIVITY_START,
    COMMON_COLUMNS,
    IP_CHECK_KEY,
    TRACE_KEY,
    prefixed,
)


def start_columns() -> list[Column]:
    return [F.col(c).alias(prefixed("s", c)) for c in COMMON_COLUMNS] + [
        F.col("payload")[TRACE_KEY].alias(prefixed("s", TRACE_KEY))
    ]


def end_columns() -> list[Column]:
    return [F.col(c).alias(prefixed("e", c)) for c in COMMON_COLUMNS] + [
        F.col("durationInMillis"),
        F.col("payload")[TRACE_KEY].alias(prefixed("e", TRACE_KEY)),
        F.col("payload")[IP_CHECK_KEY].alias(IP_CHECK_KEY),
    ]


def starts(events: DataFrame) -> DataFrame:
    return events.where(F.col("eventType") == ACTIVITY_START).select(*start_columns())


def ends(events: DataFrame) -> DataFrame:
    return events.where(F.col("eventType") == ACTIVITY_END).select(*end_columns())
