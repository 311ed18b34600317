from spanwatch.streaming.jobs import (
    correlation_batch,
    phases_batch,
    read_alarms,
    read_batches,
    read_correlated,
    read_documents,
    read_phases,
    read_trace_counts,
    read_unmatched,
    run_batches,
    run_correlation,
    run_phases,
    to_console,
)
from spanwatch.streaming.join import (
    run_key_totals,
    stream_correlated,
    stream_key_totals,
    stream_phases,
)

__all__ = [
    "correlation_batch",
    "phases_batch",
    "read_alarms",
    "read_batches",
    "read_correlated",
    "read_documents",
    "read_phases",
    "read_trace_counts",
    "read_unmatched",
    "run_batches",
    "run_correlation",
    "run_phases",
    "run_key_totals",
    "stream_correlated",
    "stream_key_totals",
    "stream_phases",
    "to_console",
]
