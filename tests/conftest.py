import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from spanwatch.schema import EVENT_COLUMNS, EVENT_SCHEMA  # noqa: E402
from spanwatch.session import build_session  # noqa: E402

os.environ["TZ"] = "UTC"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g",
        spark__sql__codegen__wholeStage=os.environ.get("TEST_CODEGEN", "true"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


@pytest.fixture
def make_events(spark):
    """Event records from short rows: type, trace, and any other column by name."""

    def make(*rows):
        records = []
        for kind, trace, *more in rows:
            other = {
                "version": 1, "timestamp": at("2024-01-01T10:00:00"), "documentType": "bam_event",
                "eventType": f"ACTIVITY_{kind}", "businessProcessName": "p",
                "businessProcessActivityId": "a", "durationInMillis": 0,
                "payload": {"spp_trace_wf_id": trace} if trace else {},
                **(more[0] if more else {}),
            }
            records.append(tuple(other.get(c) for c in EVENT_COLUMNS))
        return spark.createDataFrame(records, EVENT_SCHEMA)

    return make
