"""Schemas of the event record and the phase rules, and the names of both sides' columns."""

from pyspark.sql import types as T

# Names and types of the event record, in record order.
EVENT_FIELDS = [
    ("version", "@version", T.IntegerType()),
    ("timestamp", "@timestamp", T.TimestampType()),
    ("documentType", "documentType", T.StringType()),
    ("eventType", "eventType", T.StringType()),
    ("technicalOrigin", "technicalOrigin", T.StringType()),
    ("businessOrigin", "businessOrigin", T.StringType()),
    ("businessProcessId", "businessProcessId", T.StringType()),
    ("businessProcessName", "businessProcessName", T.StringType()),
    ("businessProcessVersion", "businessProcessVersion", T.StringType()),
    ("businessProcessActivityId", "businessProcessActivityId", T.StringType()),
    ("businessProcessActivityName", "businessProcessActivityName", T.StringType()),
    ("businessProcessInstanceId", "businessProcessInstanceId", T.StringType()),
    ("durationInMillis", "durationInMillis", T.LongType()),
    ("payload", "payload", T.MapType(T.StringType(), T.StringType())),
]
ACTIVITY_START = "ACTIVITY_START"
ACTIVITY_END = "ACTIVITY_END"
TRACE_KEY = "spp_trace_wf_id"
IP_CHECK_KEY = "ipCheckResult"

EVENT_SCHEMA = T.StructType([T.StructField(name, t) for name, _, t in EVENT_FIELDS])
EVENT_COLUMNS = EVENT_SCHEMA.fieldNames()

# The twelve columns that both sides of a pair carry under a one-letter prefix.
COMMON_COLUMNS = [c for c in EVENT_COLUMNS if c not in ("durationInMillis", "payload")]


def prefixed(prefix: str, column: str) -> str:
    return prefix + column[0].upper() + column[1:]


START_COLUMNS = [prefixed("s", c) for c in COMMON_COLUMNS] + [prefixed("s", TRACE_KEY)]
END_COLUMNS = (
    [prefixed("e", c) for c in COMMON_COLUMNS]
    + ["durationInMillis", prefixed("e", TRACE_KEY), IP_CHECK_KEY]
)
FINISHED_COLUMNS = COMMON_COLUMNS + ["durationInMillis", TRACE_KEY, IP_CHECK_KEY]

# A start and an end belong together when these three agree; null agrees with nothing.
PAIR_KEYS = ["businessProcessName", "businessProcessActivityId", TRACE_KEY]
START_KEYS = [prefixed("s", c) for c in PAIR_KEYS]
END_KEYS = [prefixed("e", c) for c in PAIR_KEYS]

RULES_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "businessProcessName",
            "businessProcessPhaseName",
            "startActivityId",
            "startType",
            "endActivityId",
            "endType",
        )
    ]
    + [T.StructField("threshold", T.LongType())]
)
