import json

import pytest

from spanwatch.schema import EVENT_COLUMNS
from spanwatch.sources import (
    parse_events,
    raw_file_records,
    raw_records,
    read_events,
    read_rules,
    read_values,
    write_events,
)
from tests.conftest import at


def parse(spark, *values):
    frame = spark.createDataFrame([(v,) for v in values], "value string")
    events, rejects = parse_events(frame)
    return events.collect(), {r.value: r.reason for r in rejects.collect()}


def message(**fields):
    return json.dumps({"@timestamp": "2024-01-01T10:00:00.100Z", **fields})


def test_all_fields(spark):
    text = message(
        **{"@version": 2}, documentType="bam_event", eventType="ACTIVITY_END", technicalOrigin="h",
        businessOrigin="b", businessProcessId="pi", businessProcessName="pn",
        businessProcessVersion="1.0", businessProcessActivityId="ai",
        businessProcessActivityName=None, businessProcessInstanceId="in", durationInMillis=60,
        payload={"ipCheckResult": "YES", "spp_trace_wf_id": "t"},
    )
    [row], rejects = parse(spark, text)
    assert rejects == {}
    assert list(row.asDict()) == EVENT_COLUMNS
    assert (row.version, row.durationInMillis, row.businessProcessActivityName) == (2, 60, None)
    assert row.payload == {"ipCheckResult": "YES", "spp_trace_wf_id": "t"}
    assert row.timestamp == at("2024-01-01T10:00:00.100").replace(tzinfo=None)


def test_absent_fields_take_their_defaults(spark):
    [row], _ = parse(spark, message())
    assert (row.version, row.durationInMillis, row.payload, row.eventType) == (0, 0, None, None)


def test_white_space_around_a_record(spark):
    rows, rejects = parse(spark, "\t\r\n " + message() + " \n")
    assert len(rows) == 1 and rejects == {}


def test_unknown_field_is_ignored(spark):
    rows, rejects = parse(spark, message(other={"x": 1}))
    assert len(rows) == 1 and rejects == {}


@pytest.mark.parametrize(
    "value, reason",
    [
        ("not json", "malformed"),
        ("", "malformed"),
        (None, "malformed"),
        ("[]", "malformed"),
        ('[{"@timestamp":1}]', "malformed"),
        ('{"@timestamp":"2024-01-01T10:00:00Z"', "malformed"),
        ('{"@timestamp":1,"payload":"text"}', "malformed"),
        ('{"@timestamp":1,"@version":"x"}', "number"),
        ('{"@timestamp":1,"durationInMillis":true}', "number"),
        ('{"@timestamp":1,"@version":99999999999}', "number"),
        ("{}", "timestamp"),
        ('{"@timestamp":"yesterday"}', "timestamp"),
        ('{"@timestamp":"2024-13-01T00:00:00Z"}', "timestamp"),
        ('{"@timestamp":99999999999999999999}', "timestamp"),
    ],
)
def test_rejects(spark, value, reason):
    rows, rejects = parse(spark, value, message())
    assert rejects == {value: reason}
    assert len(rows) == 1


@pytest.mark.parametrize(
    "given, number", [(60, 60), ("60", 60), (60.9, 60), ("", 0), (None, 0), (-3, -3), (2**40, 2**40)]
)
def test_durations(spark, given, number):
    [row], _ = parse(spark, message(durationInMillis=given))
    assert row.durationInMillis == number


@pytest.mark.parametrize(
    "given, time",
    [
        ("2017-07-18T12:52:17.331Z", "2017-07-18T12:52:17.331"),
        ("2017-07-18T12:52:17.331", "2017-07-18T12:52:17.331"),
        ("2017-07-18T14:52:17.331+02:00", "2017-07-18T12:52:17.331"),
        ("2017-07-18T14:52:17.331+0200", "2017-07-18T12:52:17.331"),
        ("2017-07-18", "2017-07-18T00:00:00"),
        (1500382337331, "2017-07-18T12:52:17.331"),
        ("1500382337331", "2017-07-18T12:52:17.331"),
        (0, "1970-01-01T00:00:00"),
    ],
)
def test_times(spark, given, time):
    [row], _ = parse(spark, json.dumps({"@timestamp": given}))
    assert row.timestamp == at(time).replace(tzinfo=None)


def test_nested_payload_values_become_text(spark):
    [row], _ = parse(spark, message(payload={"a": 1, "b": {"z": 1}, "c": None}))
    assert row.payload == {"a": "1", "b": '{"z":1}', "c": None}


def test_read_values_and_file_records(spark, tmp_path):
    (tmp_path / "x.json").write_text(message() + "\n" + "bad\n")
    assert read_values(spark, str(tmp_path)).count() == 2
    rows = raw_file_records(spark, str(tmp_path)).collect()
    assert {r.file.rsplit("/", 1)[1] for r in rows} == {"x.json"}


def test_raw_records(spark):
    frame = spark.sql("SELECT 3 AS partition, 7L AS offset, CAST('v' AS BINARY) AS value, 't' AS topic")
    assert [tuple(r) for r in raw_records(frame).collect()] == [(3, 7, "v")]


def test_rules_file(spark, tmp_path):
    rule = {
        "businessProcessName": "p", "businessProcessPhaseName": "ph", "startActivityId": "a",
        "startType": "ACTIVITY_START", "endActivityId": "b", "endType": "ACTIVITY_END", "threshold": 100,
    }
    (tmp_path / "phases.json").write_text(json.dumps([rule, {**rule, "threshold": 5}], indent=1))
    rules = read_rules(spark, str(tmp_path / "phases.json"))
    assert sorted(r.threshold for r in rules.collect()) == [5, 100]
    assert rules.first().asDict() | {"threshold": 0} == rule | {"threshold": 0}


def test_stored_events(spark, make_events, tmp_path):
    events = make_events(
        ("START", "t", {"timestamp": at("2024-01-01T23:00:00")}), ("END", "t", {"timestamp": at("2024-01-02T01:00:00")})
    )
    write_events(events, str(tmp_path / "events"))
    stored = read_events(spark, str(tmp_path / "events"))
    assert stored.columns == [*EVENT_COLUMNS, "eventDate"]
    assert sorted(map(str, stored.drop("eventDate").collect())) == sorted(map(str, events.collect()))
    assert stored.where("eventDate = DATE'2024-01-02'").count() == 1
