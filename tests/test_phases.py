from spanwatch import operators as op
from spanwatch.schema import RULES_SCHEMA
from tests.conftest import at

RULE = ("p", "a-to-b", "a", "ACTIVITY_START", "b", "ACTIVITY_END", 100)


def rules(spark, *rows):
    return spark.createDataFrame(list(rows), RULES_SCHEMA)


def step(kind, activity, time, instance="i"):
    return (kind, "t", {
        "businessProcessActivityId": activity, "timestamp": at(f"2024-01-01T10:00:{time}"),
        "businessProcessInstanceId": instance,
    })


def test_duration_and_kpi(spark, make_events):
    events = make_events(
        step("START", "a", "00.000", "i1"), step("END", "b", "00.100", "i1"),
        step("START", "a", "00.000", "i2"), step("END", "b", "00.101", "i2"),
        step("END", "a", "00.000", "i3"), step("START", "b", "00.050", "i3"),
    )
    rows = op.phases(events, rules(spark, RULE)).collect()
    assert {r.id: (r.durationInMillis, r.kpiStatusText, r.kpiStatusValue) for r in rows} == {
        "a-to-b_i1": (100, "OK", 0), "a-to-b_i2": (101, "NOK", 1),
    }
    assert {(r.documentType, r.kpiThresholdValue) for r in rows} == {("phase_event", 100)}


def test_each_rule_has_its_threshold_and_copies_count_once(spark, make_events):
    events = make_events(step("START", "a", "00.000"), step("END", "b", "00.050"))
    other = RULE[:1] + ("strict",) + RULE[2:6] + (10,)
    rows = op.phases(events, rules(spark, RULE, RULE, other)).collect()
    assert sorted((r.businessProcessPhaseName, r.kpiStatusText) for r in rows) == [
        ("a-to-b", "OK"), ("strict", "NOK"),
    ]


def test_null_instance_and_null_rule_parts_match_nothing(spark, make_events):
    events = make_events(step("START", "a", "00.000", None), step("END", "b", "00.050", None))
    assert op.phases(events, rules(spark, RULE)).count() == 0
    events = make_events(step("START", "a", "00.000"), step("END", "b", "00.050"))
    assert op.phases(events, rules(spark, (None,) + RULE[1:])).count() == 0


def test_negative_duration_is_kept(spark, make_events):
    events = make_events(step("START", "a", "01.000"), step("END", "b", "00.000"))
    [row] = op.phases(events, rules(spark, RULE)).collect()
    assert (row.durationInMillis, row.kpiStatusText) == (-1000, "OK")


def test_latest_equals_latest_of_all_pairs(spark, make_events):
    times = ["00.000", "03.500", "07.250", "07.250", "09.000"]
    events = make_events(
        *[step("START", "a", t, i) for t in times for i in ("i", "j")],
        *[step("END", "b", t, i) for t in reversed(times) for i in ("i", "j")],
    )
    every = op.phases(events, rules(spark, RULE))
    assert every.count() == 50
    latest = op.latest_phases(events, rules(spark, RULE))
    from spanwatch.operators.phases import latest_of

    key = ["id", "sTimestamp", "eTimestamp", "durationInMillis"]
    assert sorted(latest.select(key).collect()) == sorted(latest_of(every).select(key).collect())
    assert {r.durationInMillis for r in latest.collect()} == {0}
