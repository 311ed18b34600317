import json
import random
from datetime import timedelta

import pytest
from pyspark.sql import types as T

from spanwatch import operators as op
from spanwatch.schema import PAIR_KEYS, RULES_SCHEMA, TRACE_KEY
from spanwatch.session import stateful_session
from spanwatch.sources import DeltaLog, KeyedLog, parse_events, stream_values
from spanwatch.streaming import (
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
    run_key_totals,
    run_phases,
    stream_correlated,
    stream_phases,
    to_console,
)
from spanwatch.streaming.join import KEY_TOTALS_SCHEMA
from spanwatch.streaming.daily import DailyTargets
from spanwatch.streaming.state import ACTIVITY_SCHEMA, MARK_SCHEMA, added_up, unmatched_rows
from tests.conftest import at

NOON = at("2024-01-01T12:00:00")


def message(kind, trace, minute=0, **more):
    time = NOON + timedelta(minutes=minute)
    record = {
        "@version": 1, "@timestamp": time.strftime("%Y-%m-%dT%H:%M:%S.000Z"),
        "eventType": f"ACTIVITY_{kind}", "businessProcessName": "p",
        "businessProcessActivityId": "a", "payload": {"spp_trace_wf_id": trace} if trace else {}, **more,
    }
    return json.dumps(record)


def values(spark, *messages):
    return spark.createDataFrame([(m,) for m in messages], "value string")


def traces(frame, column="sSpp_trace_wf_id"):
    return sorted(str(r[0]) for r in frame.select(column).collect())


def unmatched(spark, out, before, **options):
    open_starts, orphans = read_unmatched(spark, out, before, **options)
    return traces(open_starts), traces(orphans, "eSpp_trace_wf_id")


def delta_log(spark, out, epoch_batches=100):
    return DeltaLog(spark, f"{out}/state", ACTIVITY_SCHEMA, MARK_SCHEMA, PAIR_KEYS, epoch_batches)


def written(spark, out, table, batch_id, epoch_batches=100):
    return spark.read.parquet(f"{out}/state/{table}/epoch={batch_id // epoch_batches}/batch_id={batch_id}").count()


LOG = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])


def log_rows(spark, *rows):
    return spark.createDataFrame(list(rows), LOG)


def test_log_keeps_the_last_rows_of_a_key(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path), LOG, ["k"], epoch_batches=2)
    assert log.read(0).count() == 0
    for batch_id, rows in enumerate([[("a", 1), ("a", 2), ("b", 3)], [("a", 4)], [("c", 5)], [("b", 6)], [("c", 7)]]):
        log.write(batch_id, log_rows(spark, *rows))
        log.close_epoch(batch_id)
    assert sorted(map(tuple, log.read(1).collect())) == [("a", 1), ("a", 2), ("b", 3)]
    assert sorted(map(tuple, log.read(5).collect())) == [("a", 4), ("b", 6), ("c", 7)]
    assert [tuple(r) for r in log.read(5, log_rows(spark, ("b", 0), ("b", 1), (None, 2))).collect()] == [("b", 6)]


def test_log_refuses_to_lose_state(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path), LOG, ["k"], epoch_batches=2)
    for batch_id in range(2):
        log.write(batch_id, log_rows(spark, ("a", batch_id)))
        log.close_epoch(batch_id)
    with pytest.raises(ValueError, match="epochs of 2"):
        KeyedLog(spark, str(tmp_path), LOG, ["k"], epoch_batches=100)
    assert log.read(3).count() == 1
    with pytest.raises(FileNotFoundError, match="epoch=2"):
        log.read(5)


def test_events_meet_those_of_earlier_batches_in_either_order(spark, tmp_path):
    out = str(tmp_path)
    run_batches(
        [
            values(spark, message("START", "t1"), message("START", "t2"), message("START", None)),
            values(spark, message("END", "t1", 1, durationInMillis=6000), message("END", "t3", 1), "bad"),
            values(spark, message("END", "t1", 2), message("START", "t3", 3), message("END", None, 1)),
            values(spark, message("START", "t1", 4), message("END", "t4", 4)),
        ],
        correlation_batch(out),
    )
    assert unmatched(spark, out, 1) == (["None", "t1", "t2"], [])
    assert unmatched(spark, out, 2) == (["None", "t2"], ["t3"])
    assert unmatched(spark, out, 4) == (["None", "t2"], ["None", "t4"])
    docs = read_documents(spark, out).collect()
    assert {d.id: d["@timestamp"].minute for d in docs} == {"p_t1": 2, "p_t3": 1}
    assert [r.value for r in spark.read.parquet(f"{out}/rejects").collect()] == ["bad"]
    # The second start of t1 makes its one violating end a violation once more.
    [alarm] = read_alarms(spark, out).collect()
    assert (alarm.processInstanceIds, int(alarm.violations)) == ("p_t1", 2)
    told = spark.read.parquet(f"{out}/alarms").collect()
    assert sorted((r.batch_id, int(r.violations)) for r in told) == [(1, 1), (3, 1)]


MESSAGES = [
    message("START", "a"), message("START", "a", 1), message("END", "a", 2, durationInMillis=7000),
    message("END", "b", 3, durationInMillis=9000), message("START", "b", 4), message("END", "c", 5),
    message("START", None, 6), message("END", "a", 7, durationInMillis=8000), message("START", "d", 60 * 24 * 30),
    message("END", None, 9), message("START", "b", 10), message("END", "d", -60 * 24 * 30),
]


def job_state(spark, out, before, **options):
    documents = [tuple(map(str, r)) for r in read_documents(spark, out).collect()]
    alarms = [tuple(map(str, r)) for r in read_alarms(spark, out).collect()]
    return sorted(documents), sorted(alarms), *unmatched(spark, out, before, **options)


def test_results_depend_on_no_cut_and_no_order(spark, tmp_path):
    """The same messages in any number of batches, in any order, and in short epochs."""
    correlation_batch(str(tmp_path / "one"))(values(spark, *MESSAGES), 0)
    wanted = job_state(spark, str(tmp_path / "one"), 1)
    assert len(wanted[0]) == 3 and wanted[2:] == (["None"], ["None", "c"])
    draw = random.Random(6)
    for n in range(3):
        shuffled, out = draw.sample(MESSAGES, len(MESSAGES)), str(tmp_path / f"many{n}")
        cuts = sorted(draw.sample(range(1, len(MESSAGES)), 2 + n))
        parts = [shuffled[i:j] for i, j in zip([0, *cuts], [*cuts, len(MESSAGES)])]
        run_batches([values(spark, *part) for part in parts], correlation_batch(out, epoch_batches=2))
        assert job_state(spark, out, len(parts), epoch_batches=2) == wanted


def test_a_retried_batch_leaves_the_same_state(spark, tmp_path):
    out = str(tmp_path)
    batch = correlation_batch(out, epoch_batches=2)
    first = values(spark, message("START", "t1"), message("START", "t2"))
    second = values(spark, message("END", "t1", 1, durationInMillis=6000), message("START", "t3", 1))
    batch(first, 0)
    batch(second, 1)
    wanted = job_state(spark, out, 2, epoch_batches=2)
    batch(second, 1)
    assert job_state(spark, out, 2, epoch_batches=2) == wanted
    assert wanted[2:] == (["t2", "t3"], [])


def test_hot_key_across_batches(spark, tmp_path):
    """Many starts and many ends of one key: one document, and what is known of the key adds up."""
    out = str(tmp_path)
    run_batches(
        [
            values(spark, *[message("START", "hot")] * 40),
            values(spark, *[message("END", "hot", i % 7, durationInMillis=i + 4990) for i in range(30)]),
            values(spark, *[message("START", "hot", 9)] * 10),
        ],
        correlation_batch(out),
    )
    [doc] = read_documents(spark, out).collect()
    assert (doc["@timestamp"].minute, doc.durationInMillis) == (6, 5017)
    [alarm] = read_alarms(spark, out).collect()
    assert int(alarm.violations) == 50 * 19
    [known] = added_up(delta_log(spark, out).marks(3), PAIR_KEYS).collect()
    assert (known.starts, known.ends, known.bad) == (50, 30, 19)


def test_an_unpaired_hot_key_writes_only_what_a_batch_adds(spark, tmp_path):
    out = str(tmp_path)
    run_batches([values(spark, *[message("START", "hot", i)] * 100) for i in range(5)], correlation_batch(out))
    assert [written(spark, out, "rows", i) for i in range(5)] == [100] * 5
    assert [written(spark, out, "marks", i) for i in range(5)] == [1] * 5
    assert len(unmatched(spark, out, 5)[0]) == 500
    correlation_batch(out)(values(spark, message("END", "hot", 9, durationInMillis=6000)), 5)
    assert written(spark, out, "rows", 5) == 0 and unmatched(spark, out, 6) == ([], [])
    assert int(read_alarms(spark, out).collect()[0].violations) == 500


def test_paired_rows_fall_away_with_the_base(spark, tmp_path):
    out = str(tmp_path)
    parts = [[message("START", "a"), message("START", "b"), message("END", "c")], [message("END", "a", 1)], [message("START", "c", 2)]]
    run_batches([values(spark, *p) for p in parts], correlation_batch(out, epoch_batches=2))
    log = delta_log(spark, out, 2)
    assert traces(log.rows(2), TRACE_KEY) == ["b", "c"]
    assert traces(unmatched_rows(log, 3), TRACE_KEY) == ["b"]
    assert traces(read_documents(spark, out), "id") == ["p_a", "p_c"]


def test_delta_log_refuses_to_lose_state(spark, tmp_path):
    out = str(tmp_path)
    run_batches([values(spark, message("START", f"t{i}")) for i in range(3)], correlation_batch(out, epoch_batches=2))
    with pytest.raises(ValueError, match="epochs of 2"):
        delta_log(spark, out)
    with pytest.raises(FileNotFoundError, match="epoch=2"):
        delta_log(spark, out, 2).marks(5)


def test_a_base_that_was_not_named_is_not_read(spark, tmp_path, monkeypatch):
    """The job breaks off between writing a base and naming it, and the batch is run again."""
    out, parts = str(tmp_path), [[message("START", "a")], [message("END", "a", 1), message("START", "b")], [message("END", "b", 2)]]
    batch = correlation_batch(out, epoch_batches=2)
    batch(values(spark, *parts[0]), 0)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(DeltaLog, "_switch", broken)
        with pytest.raises(RuntimeError, match="lost"):
            batch(values(spark, *parts[1]), 1)
    with pytest.raises(FileNotFoundError, match="epoch=1"):
        delta_log(spark, out, 2).marks(2)
    batch(values(spark, *parts[1]), 1)
    batch(values(spark, *parts[2]), 2)
    assert traces(read_documents(spark, out), "id") == ["p_a", "p_b"] and unmatched(spark, out, 3, epoch_batches=2) == ([], [])


def test_another_session_reads_the_bucketed_base(spark, tmp_path):
    out = str(tmp_path)
    run_batches([values(spark, message("START", f"t{i}")) for i in range(2)], correlation_batch(out, epoch_batches=2))
    log = delta_log(spark, out, 2)
    path, _ = log._base_path(1)
    from spanwatch.sources.delta import _table

    spark.sql(f"DROP TABLE {_table(path)}")
    assert traces(delta_log(spark.newSession(), out, 2).marks(2), TRACE_KEY) == ["t0", "t1"]


def day_message(kind, trace, day, **more):
    return message(kind, trace, 60 * 24 * day, **more)


def days_read(spark, out, day=None):
    return sorted((r.doc_date.day, r.id, r.durationInMillis) for r in read_documents(spark, out, day).collect())


def test_closed_days_are_merged_and_late_documents_join_them(spark, tmp_path, monkeypatch):
    """Days 1 and 2 are merged with the first epoch, day 1 again with the third, for a late and later version."""
    out = str(tmp_path)
    parts = [
        [day_message("START", t, 0) for t in "abc"] + [day_message("END", "a", 0, durationInMillis=1)],
        [day_message("END", "b", 1, durationInMillis=2), day_message("END", "c", 2, durationInMillis=3)],
        [day_message("END", "a", 0, durationInMillis=4)], [day_message("START", "d", 3)], [day_message("END", "d", 3)],
        [day_message("END", "b", 1, durationInMillis=5)],
    ]
    batch, wanted = correlation_batch(out, epoch_batches=2), []
    for number, part in enumerate(parts):
        batch(values(spark, *part), number)
        wanted.append(days_read(spark, out))
        for day in (1, 2, 3, 4):
            assert days_read(spark, out, f"2024-01-0{day}") == [w for w in wanted[-1] if w[0] == day]
    assert wanted[-1] == [(1, "p_a", 4), (2, "p_b", 5), (3, "p_c", 3), (4, "p_d", 0)]
    whole = str(tmp_path / "whole")
    correlation_batch(whole)(values(spark, *[m for p in parts for m in p]), 0)
    assert days_read(spark, whole) == wanted[-1]
    merged, last = DailyTargets(spark, out).last_list()
    assert last == 3
    assert sorted((r.doc_date.day, r.merged_before) for r in merged.collect()) == [(1, 2), (2, 3), (3, 3)]


def test_a_day_is_read_from_one_generation_and_the_batches_since(spark, tmp_path):
    out = str(tmp_path)
    parts = [[day_message("START", "a", 0), day_message("END", "a", 0)], [day_message("START", "b", 4), day_message("END", "b", 4)],
             [day_message("END", "a", 0, durationInMillis=7)]]
    run_batches([values(spark, *p) for p in parts], correlation_batch(out, epoch_batches=2))
    files = [f.split("/daily/")[1].rsplit("/", 1)[0] for f in read_documents(spark, out, "2024-01-01").inputFiles()]
    [generation] = {f for f in files if f.startswith("merged/")}
    assert generation.startswith("merged/doc_date=2024-01-01/run=")
    assert {f for f in files if f.startswith("documents/")} == {"documents/doc_date=2024-01-01/epoch=1/batch_id=2"}


def test_a_merge_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path)
    batch = correlation_batch(out, epoch_batches=2)
    batch(values(spark, day_message("START", "a", 0), day_message("END", "a", 0), day_message("START", "b", 5)), 0)
    last = values(spark, day_message("END", "b", 5), day_message("END", "a", 0, durationInMillis=3))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(DailyTargets, "_switch", broken)
        with pytest.raises(RuntimeError, match="lost"):
            batch(last, 1)
    assert spark.read.parquet(f"{out}/daily/merged").count() == 1
    wanted = days_read(spark, out)
    assert wanted == [(1, "p_a", 3), (6, "p_b", 0)] and days_read(spark, out, "2024-01-01") == wanted[:1]
    batch(last, 1)
    assert days_read(spark, out) == wanted and days_read(spark, out, "2024-01-01") == wanted[:1]
    batch(last, 1)  # once more, after its switch
    assert days_read(spark, out) == wanted
    assert DailyTargets(spark, out).last_list()[0].count() == 1


def activity_of(kind, trace, minute, activity, **more):
    return message(kind, trace, minute, businessProcessActivityName=activity, **more)


NAMED = [
    activity_of("START", "a", 0, "x"), activity_of("START", "a", 1, "y"), activity_of("END", "a", 2, "x", durationInMillis=7000),
    activity_of("END", "a", 3, None, durationInMillis=8000), activity_of("END", "b", 4, "y", durationInMillis=9000),
    activity_of("START", "b", 5, None), activity_of("END", "c", 6, "x"), activity_of("START", "d", 7, "x"),
    activity_of("START", None, 8, "x"), activity_of("END", None, 9, "y", durationInMillis=9999), "bad", "[]",
]


def correlated_rows(frame):
    names = sorted(set(frame.columns) - {"payload"})
    return sorted(tuple(str(r[c]) for c in names) for r in frame.select(*names).collect())


def trace_rows(spark, out):
    return sorted((str(r[TRACE_KEY]), int(r.finished), int(r.open), int(r.orphan)) for r in read_trace_counts(spark, out).collect())


def test_links_traces_and_batches_depend_on_no_cut(spark, tmp_path):
    """Every start and end with its links, counts per trace and counted outputs, for random cuts and orders."""
    events, _ = parse_events(values(spark, *NAMED))
    wanted = correlated_rows(op.correlated_events(events))
    draw = random.Random(4)
    for n, epoch_batches in enumerate([100, 2, 3]):
        shuffled, out = draw.sample(NAMED, len(NAMED)), str(tmp_path / f"many{n}")
        cuts = sorted(draw.sample(range(1, len(NAMED)), 3 + n))
        parts = [shuffled[i:j] for i, j in zip([0, *cuts], [*cuts, len(NAMED)])] + [[]]
        run_batches([values(spark, *p) if p else values(spark, "x").limit(0) for p in parts],
                    correlation_batch(out, epoch_batches=epoch_batches, keep_events=True))
        assert correlated_rows(read_correlated(spark, out, len(parts), epoch_batches)) == wanted
        assert trace_rows(spark, out) == [("None", 0, 1, 1), ("a", 4, 0, 0), ("b", 1, 0, 0), ("c", 0, 0, 1), ("d", 0, 1, 0)]
        batches = {r.batch_id: r for r in read_batches(spark, out).collect()}
        assert sorted(batches) == list(range(len(parts)))
        for number, row in batches.items():
            count = lambda table: spark.read.parquet(f"{out}/{table}/batch_id={number}").count()
            assert row.rejected == count("rejects") and row.violatingIds == count("violations")
            assert row.openUnkeyed + row.orphansUnkeyed == count("unkeyed")
            assert row.openStored + row.orphansStored == written(spark, out, "rows", number, epoch_batches)
        assert sum(r.rejected for r in batches.values()) == 2
        assert sum(r.violations for r in batches.values()) == sum(int(r.violations) for r in read_alarms(spark, out).collect()) == 5


def test_old_rows_expire_at_the_end_of_an_epoch(spark, tmp_path):
    out, month = str(tmp_path), 60 * 24 * 30
    parts = [[message("START", "old"), message("END", "lone"), message("START", "p")],
             [message("END", "p", month), message("START", "new", month)], [message("END", "old", month)]]
    run_batches([values(spark, *p) for p in parts], correlation_batch(out, epoch_batches=2, retention="7 days"))
    assert unmatched(spark, out, 2, epoch_batches=2) == (["new"], [])
    assert traces(spark.read.parquet(f"{out}/state/expired"), TRACE_KEY) == ["lone", "old"]
    assert unmatched(spark, out, 3, epoch_batches=2) == (["new"], ["old"])
    assert traces(read_documents(spark, out), "id") == ["p_p"]


def test_job_runs_by_its_interval(spark, tmp_path):
    feed(tmp_path, 0, message("START", "t"), message("END", "t", 1))
    query = run_correlation(stream_values(spark, str(tmp_path / "in")), f"{tmp_path}/out", f"{tmp_path}/ckpt")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None and traces(read_documents(spark, f"{tmp_path}/out"), "id") == ["p_t"]


def test_another_format_is_read_back(spark, tmp_path):
    out = str(tmp_path)
    run_batches([values(spark, *MESSAGES)], correlation_batch(out, fmt="orc"))
    assert read_documents(spark, out, fmt="orc").count() == 3
    assert read_alarms(spark, out, fmt="orc").count() == 1


def feed(root, part, *messages):
    (root / "in").mkdir(exist_ok=True)
    (root / "in" / f"{part}.json").write_text("\n".join(messages) + "\n")


def test_correlation_job_goes_on_from_its_checkpoint(spark, tmp_path):
    def run():
        stream = stream_values(spark, str(tmp_path / "in"))
        run_correlation(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", trigger=None).awaitTermination()
        return read_documents(spark, f"{tmp_path}/out")

    feed(tmp_path, 0, message("START", "t1"), message("START", "t2"), message("END", "t2", 1))
    assert traces(run(), "id") == ["p_t2"]
    feed(tmp_path, 1, message("END", "t1", 5))
    assert traces(run(), "id") == ["p_t1", "p_t2"]
    assert traces(run(), "id") == ["p_t1", "p_t2"]
    assert read_documents(spark, f"{tmp_path}/out", "2024-01-01").count() == 2


def collect_join(spark, tmp_path, *parts, gap="10 days"):
    """Run the streaming join, restarted for each part, and return what it put out."""
    own = stateful_session(spark, 2)
    for number, messages in enumerate(parts):
        feed(tmp_path, number, *messages)
        events, _ = parse_events(stream_values(own, str(tmp_path / "in")))
        (
            stream_correlated(events, max_gap=gap)
            .writeStream.format("parquet").option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True)
            .start().awaitTermination()
        )
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    return sorted((str(r.sSpp_trace_wf_id), str(r.eSpp_trace_wf_id)) for r in rows)


LATER = 60 * 24 * 100


def test_stream_join_matches_in_either_order_and_across_batches(spark, tmp_path):
    first = [message("START", "t1"), message("END", "t2", 1), message("START", "t3"), message("START", None)]
    second = [message("END", "t1", 3), message("START", "t2", 2), message("END", "t4", 2), message("END", None)]
    flush = [message("START", "s1", LATER), message("END", "s2", LATER)]
    assert collect_join(spark, tmp_path, first, second, flush) == [
        ("None", "None"), ("None", "None"), ("None", "t4"), ("t1", "t1"), ("t2", "t2"), ("t3", "None"),
    ]


def test_stream_join_needs_no_null_keys_to_advance(spark, tmp_path):
    first = [message("START", "t1"), message("END", "t1", 1), message("START", "t3")]
    flush = [message("START", "s1", LATER), message("END", "s2", LATER)]
    assert collect_join(spark, tmp_path, first, flush) == [("t1", "t1"), ("t3", "None")]


@pytest.mark.parametrize("cuts", [[6], [1, 3, 5]])
def test_any_split_gives_the_batch_result(spark, tmp_path, cuts):
    messages = [
        message("START", "a"), message("START", "a", 1), message("END", "a", 2),
        message("END", "b", 3), message("START", "b", 4), message("END", "c", 5), message("START", None, 6),
    ]
    bounds = [0, *cuts, len(messages)]
    parts = [messages[i:j] for i, j in zip(bounds, bounds[1:])]
    flush = [message("START", "s1", LATER), message("END", "s2", LATER)]
    got = collect_join(spark, tmp_path, *parts, flush)
    events, _ = parse_events(values(spark, *messages))
    rows = op.correlated(events).collect()
    assert got == sorted((str(r.sSpp_trace_wf_id), str(r.eSpp_trace_wf_id)) for r in rows)


RULES = [("p", "ph", "a", "ACTIVITY_START", "a", "ACTIVITY_END", 100)]


def test_phases_job(spark, tmp_path):
    rules = spark.createDataFrame(RULES, RULES_SCHEMA)
    i1 = {"businessProcessInstanceId": "i1"}
    feed(tmp_path, 0, message("START", "t", **i1), message("END", "t", 1, **i1), message("END", "t", 2, **i1))
    stream = stream_values(spark, str(tmp_path / "in"))
    run_phases(stream, rules, f"{tmp_path}/out", f"{tmp_path}/ckpt", trigger=None).awaitTermination()
    [row] = read_phases(spark, f"{tmp_path}/out").collect()
    assert (row.id, row.durationInMillis, row.kpiStatusText) == ("ph_i1", 120000, "NOK")


def test_phases_depend_on_no_cut_and_no_order(spark, tmp_path):
    rules = spark.createDataFrame([RULES[0], ("p", "ab", "a", "ACTIVITY_START", "b", "ACTIVITY_END", 90_000)], RULES_SCHEMA)
    messages = [
        message(kind, "t", minute, businessProcessInstanceId=instance, businessProcessActivityId=activity)
        for minute, (kind, instance, activity) in enumerate(
            [("START", "i", "a"), ("END", "i", "b"), ("END", "i", "a"), ("START", "j", "a"), ("START", "i", "a"),
             ("END", "j", "b"), ("END", "k", "a"), ("START", None, "a"), ("END", None, "a")]
        )
    ]

    def found(out):
        return sorted(tuple(map(str, r)) for r in read_phases(spark, out).drop("sPayload", "ePayload").collect())

    run_batches([values(spark, *messages)], phases_batch(str(tmp_path / "one"), rules))
    wanted = found(str(tmp_path / "one"))
    assert len(wanted) == 3
    draw = random.Random(2)
    for n, size in enumerate([1, 2, 4]):
        shuffled, out = draw.sample(messages, len(messages)), str(tmp_path / f"many{n}")
        parts = [shuffled[i : i + size] for i in range(0, len(messages), size)]
        run_batches([values(spark, *part) for part in parts], phases_batch(out, rules, epoch_batches=3))
        assert found(out) == wanted


@pytest.mark.parametrize("retention", [None, "5 minutes"])
def test_phases_of_random_cuts_with_and_without_expiry(spark, tmp_path, retention):
    """Against a plain run over batches that forgets instances when an epoch ends."""
    rules = spark.createDataFrame(RULES, RULES_SCHEMA)
    draw = random.Random(11)
    rows = [(draw.choice(["START", "END"]), f"i{draw.randrange(6)}", minute) for minute in range(36)]
    for n in range(2):
        cuts = sorted(draw.sample(range(1, 36), 6))
        parts = [draw.sample(rows[i:j], j - i) for i, j in zip([0, *cuts], [*cuts, 36])]
        out = str(tmp_path / f"cut{n}")
        batch = phases_batch(out, rules, epoch_batches=2, retention=retention)
        known, latest, gone = {}, {}, []
        for number, part in enumerate(parts):
            batch(values(spark, *[message(k, "t", m, businessProcessInstanceId=i) for k, i, m in part]), number)
            for kind, instance, minute in part:
                sides = known.setdefault(instance, {})
                sides[kind] = max(sides.get(kind, -1), minute)
            for instance in {i for _, i, _ in part}:
                sides = known[instance]
                if len(sides) == 2:
                    new = (sides["END"], sides["START"])
                    latest[instance] = max(latest.get(instance, new), new)
            if number % 2 and retention:
                newest = max(m for _, _, m in part)
                old = [i for i, sides in known.items() if max(sides.values()) < newest - 5]
                gone += [(i, kind) for i in old for kind in known.pop(i)]
        got = {r.businessProcessInstanceId: r.durationInMillis for r in read_phases(spark, out).collect()}
        assert got == {i: (e - s) * 60_000 for i, (e, s) in latest.items()}
        if retention:
            expired = spark.read.parquet(f"{out}/phase_sides/expired").collect()
            assert sorted((r.businessProcessInstanceId, r.side) for r in expired) == sorted((i, k[0].lower()) for i, k in gone)
            assert gone


def test_totals_of_a_stream_take_late_and_far_events(spark, tmp_path):
    """The source is read once, and an event weeks behind the others still counts."""
    parts = [
        [message("END", "t", LATER), message("START", "u", LATER), message("START", None)],
        [message("START", "t"), message("START", "t", 1), message("END", "u", -LATER)],
    ]
    own = stateful_session(spark, 2)
    for number, part in enumerate(parts):
        feed(tmp_path, number, *part)
        events, _ = parse_events(stream_values(own, str(tmp_path / "in")))
        query = run_key_totals(events, f"{tmp_path}/out", f"{tmp_path}/ckpt", trigger=None)
        query.awaitTermination()
        assert sum(p.numInputRows for p in query.recentProgress) == len(part)
    log = KeyedLog(spark, f"{tmp_path}/out", KEY_TOTALS_SCHEMA, PAIR_KEYS)
    assert sorted((r[TRACE_KEY], r.starts, r.ends) for r in log.read(2).collect()) == [("t", 2, 1), ("u", 1, 1)]


def test_stream_phases_across_batches(spark, tmp_path):
    own = stateful_session(spark, 2)
    rules = own.createDataFrame(RULES, RULES_SCHEMA)
    i1 = {"businessProcessInstanceId": "i1"}
    for part, text in enumerate([message("START", "t", **i1), message("END", "t", 1, **i1)]):
        feed(tmp_path, part, text)
        events, _ = parse_events(stream_values(own, str(tmp_path / "in")))
        (
            stream_phases(events, rules).select("id", "durationInMillis")
            .writeStream.format("parquet").option("path", f"{tmp_path}/out")
            .option("checkpointLocation", f"{tmp_path}/ckpt").trigger(availableNow=True)
            .start().awaitTermination()
        )
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("ph_i1", 60000)]


def test_console(spark, tmp_path):
    feed(tmp_path, 0, message("START", "t1"))
    query = to_console(stream_values(spark, str(tmp_path / "in")))
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None


def test_kafka_is_named_as_the_source(spark):
    """The connector is not installed here; the error shows that it was asked for."""
    with pytest.raises(Exception, match="kafka"):
        stream_values(spark, topics="a,b", servers="host:9092")
