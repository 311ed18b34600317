"""The registered queries: each operator over the whole ``events`` table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch import operators as op
from spanwatch.functions import iso_utc
from spanwatch.schema import (
    ACTIVITY_START,
    COMMON_COLUMNS,
    IP_CHECK_KEY,
    PAIR_KEYS,
    TRACE_KEY,
    prefixed,
)
from spanwatch.session import stateful_session, work_dir
from spanwatch.sources import KeyedLog, parse_events, raw_records, read_rules, stream_values
from spanwatch.sources.tables import (
    activity_events,
    as_json_values,
    crossing_events,
    crossing_rules,
    phase_rules,
    process_events,
)
from spanwatch.streaming import (
    read_alarms,
    read_correlated,
    read_documents,
    read_phases,
    read_trace_counts,
    read_unmatched,
    run_correlation,
    run_key_totals,
    run_phases,
)
from spanwatch.streaming.join import KEY_TOTALS_SCHEMA

# Fixed value: where the two-batch queries cut the table.
CUT = "2024-01-16 00:00:00"
FINISHED_GROUP = ("businessProcessName", TRACE_KEY)
START_GROUP = (prefixed("s", "businessProcessName"), prefixed("s", TRACE_KEY))
END_GROUP = (prefixed("e", "businessProcessName"), prefixed("e", TRACE_KEY))


def _flat(events: DataFrame) -> DataFrame:
    """The payload's two keys as columns; maps do not compare."""
    return events.withColumns(
        {k: F.col("payload")[k] for k in (TRACE_KEY, IP_CHECK_KEY)}
    ).drop("payload")


def _payload_columns(docs: DataFrame) -> DataFrame:
    keys = (TRACE_KEY, IP_CHECK_KEY, "kpiThresholdValue", "kpiStatusText", "kpiStatusValue")
    return docs.withColumns({k: F.col("payload")[k] for k in keys}).drop("payload").withColumn(
        "@timestamp", F.col("`@timestamp`").cast("timestamp_ntz")
    )


def _cut(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    ts = F.col("timestamp")
    return events.where(ts < F.lit(CUT).cast("timestamp_ntz")), events.where(
        ts >= F.lit(CUT).cast("timestamp_ntz")
    )


def _documents(spark, sf_dir):
    return op.documents(op.finished(activity_events(spark, sf_dir)))


def q_parse_events(spark, sf_dir):
    events, _ = parse_events(as_json_values(process_events(spark, sf_dir)))
    return _flat(events).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def q_parse_rejects(spark, sf_dir):
    """Messages of which some are spoilt, by a rule on their text, before they are parsed."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("bigint")
    values = table.select(
        F.when(k % 10 == 0, F.concat(F.lit("not json "), "props"))
        .when(k % 10 == 1, F.lit(""))
        .when(k % 10 == 2, F.concat(F.lit('{"@version":"x'), F.col("event_id").cast("string"),
                                    F.lit('","@timestamp":"2024-01-01T00:00:00Z"}')))
        .when(k % 10 == 3, F.concat(F.lit('{"eventType":"'), "event_type", F.lit('"}')))
        .otherwise(F.concat(F.lit('{"@timestamp":1704067200000,"eventType":"'), "event_type", F.lit('"}')))
        .alias("value")
    )
    return parse_events(values).rejects


def q_raw_records(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    topic = table.select(
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    return raw_records(topic)


def _rules_from_file(spark, rules: DataFrame) -> DataFrame:
    """Rules as users give them: a JSON array in a file."""
    path = work_dir(spark, "rules")
    rules.agg(F.to_json(F.collect_list(F.struct(*rules.columns)))).write.text(path)
    return read_rules(spark, path)


def q_phase_rules(spark, sf_dir):
    """How many events each rule finds for either side; rules that find none are listed too."""
    rules = _rules_from_file(spark, phase_rules(spark))
    found = op.phase_events(activity_events(spark, sf_dir), rules)
    per_rule = found.groupBy("rule").agg(
        F.count_if(F.col("side") == "s").alias("starts"), F.count_if(F.col("side") == "e").alias("ends")
    )
    names = rules.columns
    counted = per_rule.select(*[F.col(f"rule.{c}").alias(c) for c in names], "starts", "ends")
    return rules.join(counted, names, "left").na.fill(0, ["starts", "ends"])


def q_start_events(spark, sf_dir):
    return op.starts(activity_events(spark, sf_dir))


def q_end_events(spark, sf_dir):
    return op.ends(activity_events(spark, sf_dir))


def q_correlated(spark, sf_dir):
    return op.correlated_events(activity_events(spark, sf_dir))


def q_classified(spark, sf_dir):
    return op.classify(activity_events(spark, sf_dir))


def q_finished_events(spark, sf_dir):
    return op.finished(activity_events(spark, sf_dir))


def q_starts_without_end(spark, sf_dir):
    return op.starts_without_end(activity_events(spark, sf_dir))


def q_ends_without_start(spark, sf_dir):
    return op.ends_without_start(activity_events(spark, sf_dir))


def q_kpi_status(spark, sf_dir):
    return op.with_kpi(op.finished(activity_events(spark, sf_dir)))


def q_kpi_violations(spark, sf_dir):
    checked = op.with_kpi(op.finished(activity_events(spark, sf_dir)))
    return op.violations(checked)


def q_violation_count(spark, sf_dir):
    checked = op.with_kpi(op.finished(activity_events(spark, sf_dir)))
    counted = op.violation_count(op.violations(checked))
    return counted.withColumn("violations", F.col("violations").cast("bigint"))


def q_documents(spark, sf_dir):
    return _payload_columns(_documents(spark, sf_dir))


def q_documents_latest(spark, sf_dir):
    return _payload_columns(op.latest_documents(_documents(spark, sf_dir)))


def q_daily_documents(spark, sf_dir):
    return _payload_columns(op.daily_documents(_documents(spark, sf_dir)))


def q_iso_timestamps(spark, sf_dir):
    events = _flat(process_events(spark, sf_dir))
    return events.select(
        "businessProcessInstanceId", "eventType", iso_utc("timestamp").alias("isoTimestamp")
    )


def q_finished_per_trace(spark, sf_dir):
    counts = op.trace_counts(op.pair_counts(activity_events(spark, sf_dir)), *FINISHED_GROUP, weight="count")
    return counts.withColumn("count", F.col("count").cast("bigint"))


def q_open_per_trace(spark, sf_dir):
    return op.trace_counts(q_starts_without_end(spark, sf_dir), *START_GROUP)


def q_orphans_per_trace(spark, sf_dir):
    return op.trace_counts(q_ends_without_start(spark, sf_dir), *END_GROUP)


def q_group_counts(spark, sf_dir):
    """Groups per class: three classes come from one pass over the events."""
    is_start, alone = F.col("eventType") == ACTIVITY_START, F.col("matches") == 0
    kind = F.when(is_start & alone, "open").when(~is_start & alone, "orphan").when(~is_start, "finished")
    group = ["kind", *FINISHED_GROUP]
    classes = op.classify(activity_events(spark, sf_dir)).withColumn("kind", kind).where("kind IS NOT NULL")
    resolved = _resolved(spark, sf_dir).withColumn("kind", F.lit("resolved"))
    groups = classes.select(*group).union(resolved.select(*group)).distinct()
    return groups.groupBy("kind").agg(F.count(F.lit(1)).alias("groups"))


def q_alarm_ids(spark, sf_dir):
    return op.alarm_ids(_documents(spark, sf_dir))


def _whole_counts(alarm_rows: DataFrame) -> DataFrame:
    return alarm_rows.withColumns(
        {c: F.col(c).cast("bigint") for c in ("violations", "allViolations")}
    )


def q_alarms(spark, sf_dir):
    return _whole_counts(op.alarms(_documents(spark, sf_dir)))


def q_alarm_pages(spark, sf_dir):
    """Alarms in pages of about four ids."""
    return _whole_counts(op.alarms(_documents(spark, sf_dir), page_ids=4))


def q_alarm_messages(spark, sf_dir):
    return op.alarm_messages(q_alarms(spark, sf_dir)).select("subject", "page", "message")


def _two_batches(spark, sf_dir):
    first, second = _cut(activity_events(spark, sf_dir))
    return op.starts_without_end(first), op.ends_without_start(second)


def _resolved(spark, sf_dir):
    return op.resolve_pending(*_two_batches(spark, sf_dir))


def q_resolve_pending(spark, sf_dir):
    return _resolved(spark, sf_dir)


def q_still_pending(spark, sf_dir):
    return op.still_pending(*_two_batches(spark, sf_dir))


def q_unresolved_ends(spark, sf_dir):
    return op.unresolved_ends(*_two_batches(spark, sf_dir))


def q_phase_events(spark, sf_dir):
    tagged = op.phase_events(activity_events(spark, sf_dir), phase_rules(spark))
    return _flat(
        tagged.withColumn("businessProcessPhaseName", F.col("rule.businessProcessPhaseName")).drop("rule")
    )


PHASE_COLUMNS = [
    "businessProcessInstanceId",
    *[prefixed(s, c) for s in "se" for c in COMMON_COLUMNS if c != "businessProcessInstanceId"],
    "businessProcessPhaseName",
    "id",
    "durationInMillis",
]
PHASE_KPI_COLUMNS = ["kpiThresholdValue", "kpiStatusText", "kpiStatusValue", "documentType"]


PHASE_END_COLUMNS = [
    "businessProcessInstanceId",
    "sTimestamp",
    *[prefixed("e", c) for c in COMMON_COLUMNS if c != "businessProcessInstanceId"],
    "businessProcessPhaseName",
    "id",
    "durationInMillis",
    "matches",
]


def q_phases(spark, sf_dir):
    return op.phase_ends(activity_events(spark, sf_dir), phase_rules(spark)).select(*PHASE_END_COLUMNS)


def q_phase_kpi(spark, sf_dir):
    measured = op.phase_ends(activity_events(spark, sf_dir), phase_rules(spark))
    return measured.select("id", "durationInMillis", "matches", *PHASE_KPI_COLUMNS)


def q_phases_cross(spark, sf_dir):
    """Phases between two different activities, by rules read from a file."""
    rules = _rules_from_file(spark, crossing_rules(spark))
    return op.phase_ends(crossing_events(spark, sf_dir), rules).select(*PHASE_END_COLUMNS, *PHASE_KPI_COLUMNS)


def q_phases_latest(spark, sf_dir):
    latest = op.latest_phases(activity_events(spark, sf_dir), phase_rules(spark))
    return latest.select(*PHASE_COLUMNS, *PHASE_KPI_COLUMNS)


def _slices(spark, sf_dir) -> list[DataFrame]:
    """The table as JSON messages, in two parts by time."""
    return [as_json_values(part) for part in _cut(activity_events(spark, sf_dir))]


def _ntz(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(f"`{c}`").cast("timestamp_ntz") for c in columns})


def _stream_job(spark, sf_dir, start) -> str:
    """Feed the parts to a job one after the other, restarting it in between; the output folder."""
    root = work_dir(spark, "job")
    for part in _slices(spark, sf_dir):
        part.write.mode("append").text(f"{root}/in")
        start(stream_values(spark, f"{root}/in"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def _run_correlation(spark, sf_dir) -> str:
    return _stream_job(
        spark, sf_dir, lambda values, out, ckpt: run_correlation(values, out, ckpt, trigger=None)
    )


def q_stream_documents(spark, sf_dir):
    return _payload_columns(read_documents(spark, _run_correlation(spark, sf_dir)))


def q_stream_pending(spark, sf_dir):
    open_starts, _ = read_unmatched(spark, _run_correlation(spark, sf_dir), before=2)
    return _ntz(open_starts, "sTimestamp")


def q_stream_orphans(spark, sf_dir):
    _, orphans = read_unmatched(spark, _run_correlation(spark, sf_dir), before=2)
    return _ntz(orphans, "eTimestamp")


def q_stream_alarms(spark, sf_dir):
    return _whole_counts(read_alarms(spark, _run_correlation(spark, sf_dir)))


def q_stream_phases(spark, sf_dir):
    rules = phase_rules(spark)
    out = _stream_job(
        spark, sf_dir, lambda values, out, ckpt: run_phases(values, rules, out, ckpt, trigger=None)
    )
    latest = read_phases(spark, out).select(*PHASE_COLUMNS, *PHASE_KPI_COLUMNS)
    return _ntz(latest, "sTimestamp", "eTimestamp")


def q_stream_per_trace(spark, sf_dir):
    """Finished pairs, open starts and orphan ends per process and trace, kept up by the job's batches."""
    counts = read_trace_counts(spark, _run_correlation(spark, sf_dir))
    return counts.withColumns({c: F.col(c).cast("bigint") for c in ("finished", "open", "orphan")})


def _late_half_first(spark, sf_dir, name: str, start) -> str:
    """Feed the parts to a job, restarted in between, of which the later one comes first; the output folder."""
    root = work_dir(spark, name)
    for part in reversed(_slices(spark, sf_dir)):
        part.write.mode("append").text(f"{root}/in")
        start(f"{root}/in", f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def q_stream_correlated(spark, sf_dir):
    """Every start and end of a stream with its links; the later half of the events comes first."""
    out = _late_half_first(spark, sf_dir, "correlated", lambda path, out, ckpt: run_correlation(
        stream_values(spark, path), out, ckpt, trigger=None, keep_events=True))
    return _ntz(read_correlated(spark, out, before=2), "timestamp", "partnerTimestamp")


def q_stream_key_totals(spark, sf_dir):
    """Totals per key of a stream as keyed state; the later half of the events comes first."""
    own = stateful_session(spark)
    out = _late_half_first(spark, sf_dir, "totals", lambda path, out, ckpt: run_key_totals(
        parse_events(stream_values(own, path))[0], out, ckpt, trigger=None))
    totals = KeyedLog(spark, out, KEY_TOTALS_SCHEMA, PAIR_KEYS).read(before=2)
    return _ntz(totals, "lastStart", "lastEnd")


QUERIES = {name: f for name, f in sorted(globals().items()) if name.startswith("q_")}
