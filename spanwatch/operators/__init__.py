from spanwatch.operators.alarms import alarm_ids, alarm_messages, alarms
from spanwatch.operators.correlate import (
    classify,
    correlated,
    correlated_events,
    ends_without_start,
    finished,
    finished_events,
    open_side,
    orphan_side,
    finished_side,
    starts_without_end,
)
from spanwatch.operators.documents import (
    daily_documents,
    documents,
    latest_documents,
    violations,
    with_kpi,
)
from spanwatch.operators.matching import expand_matches
from spanwatch.operators.pending import (
    look_up,
    resolve_pending,
    resolved_keys,
    resolved_side,
    still_pending,
    unresolved_ends,
    unresolved_side,
)
from spanwatch.operators.phases import latest_phases, phase_ends, phase_events, phases
from spanwatch.operators.reports import group_count, pair_counts, trace_counts, violation_count
from spanwatch.operators.sides import ends, starts

__all__ = [
    "alarm_ids",
    "alarm_messages",
    "alarms",
    "classify",
    "correlated",
    "correlated_events",
    "daily_documents",
    "documents",
    "ends",
    "ends_without_start",
    "expand_matches",
    "finished",
    "finished_events",
    "finished_side",
    "group_count",
    "latest_documents",
    "latest_phases",
    "look_up",
    "open_side",
    "orphan_side",
    "pair_counts",
    "phase_ends",
    "phase_events",
    "phases",
    "resolve_pending",
    "resolved_keys",
    "resolved_side",
    "starts",
    "starts_without_end",
    "still_pending",
    "trace_counts",
    "unresolved_ends",
    "unresolved_side",
    "violation_count",
    "violations",
    "with_kpi",
]
