from spanwatch.sources.delta import DeltaLog
from spanwatch.sources.events import (
    EventBatch,
    parse_events,
    parse_records,
    raw_file_records,
    raw_records,
    read_events,
    read_values,
    split_parsed,
    stream_values,
    write_events,
)
from spanwatch.sources.pending import KeyedLog
from spanwatch.sources.rules import read_rules

__all__ = [
    "DeltaLog",
    "EventBatch",
    "KeyedLog",
    "parse_events",
    "parse_records",
    "raw_file_records",
    "raw_records",
    "read_events",
    "read_rules",
    "read_values",
    "split_parsed",
    "stream_values",
    "write_events",
]
