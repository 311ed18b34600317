"""The two continuous jobs: correlation and phases, with their state in tables.

Each micro-batch is a set of ordinary batch queries, so adaptive execution sizes
partitions and splits skewed keys as in a batch job. All output of a batch lies in
folders named by its ``batch_id``, which are overwritten when the batch is run again.
What the readers below return does not depend on where the batches were cut, nor on
the order in which events came.
"""

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spanwatch import operators as op
from spanwatch.operators.alarms import alarms_of
from spanwatch.operators.documents import KPI_THRESHOLD
from spanwatch.operators.matching import complete, join_key_counts, key_counts, keyed_or_spread
from spanwatch.operators.phases import (
    INSTANCE,
    PHASE_SCHEMA,
    SIDE_KEYS,
    SIDE_SCHEMA,
    latest_of,
    measured_sides,
    newest_sides,
    phase_sides,
)
from spanwatch.schema import ACTIVITY_END, PAIR_KEYS, TRACE_KEY
from spanwatch.sources.delta import DeltaLog
from spanwatch.sources.events import parse_records, split_parsed
from spanwatch.sources.pending import BATCH, EPOCH_BATCHES, KeyedLog, read_or_empty
from spanwatch.streaming.daily import DailyTargets
from spanwatch.streaming.state import (
    ACTIVITY_COLUMNS,
    ACTIVITY_SCHEMA,
    MARK_SCHEMA,
    PAIRED,
    WAS_PAIRED,
    activities,
    added_up,
    is_end,
    is_start,
    key_marks,
    key_totals,
    marks_after,
    new_trace_counts,
    new_violations,
    newly_finished,
    next_base,
    unmatched_rows,
    with_totals,
)

TRIGGER = "60 seconds"
WRITERS = 4  # outputs of a batch that are written at a time
Batch = Callable[[DataFrame, int], None]
VIOLATION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("businessProcessName", "businessProcessActivityName", "id")]
    + [T.StructField("n", T.DecimalType(38, 0))]
)


TRACE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("businessProcessName", TRACE_KEY)]
    + [T.StructField(c, T.DecimalType(38, 0)) for c in ("finished", "open", "orphan")]
)
# What a batch counts, by the output where it is counted.
COUNTS = {
    "rejects": ["rejected"],
    "unkeyed": ["openUnkeyed", "orphansUnkeyed"],
    "finished": ["finishedEnds", "finishedPairs"],
    "stored": ["openStored", "orphansStored"],
    "violations": ["violatingIds", "violations"],
}


def _numbers(table: str) -> list[Column]:
    rows, open_, orphans = F.count(F.lit(1)), F.count_if(is_start()), F.count_if(is_end())
    totals = {
        "rejects": [rows], "unkeyed": [open_, orphans], "stored": [open_, orphans], "violations": [rows, F.sum("n")],
        "finished": [rows, F.sum(F.col("matches").cast("decimal(19,0)"))],
    }
    return [total.alias(name) for total, name in zip(totals[table], COUNTS[table])]


class _Counted:
    """Numbers of a batch's outputs, taken while these are written."""

    def __init__(self, batch_id: int):
        self.batch_id, self._seen = batch_id, {}

    def __call__(self, table: str, rows: DataFrame) -> DataFrame:
        self._seen[table] = Observation(f"{table}-{self.batch_id}")
        return rows.observe(self._seen[table], *_numbers(table))

    def row(self, spark: SparkSession) -> DataFrame:
        found = {name: n for seen in self._seen.values() for name, n in seen.get.items()}
        names = [name for table in COUNTS.values() for name in table]
        return spark.range(1).select(*[F.lit(int(found.get(n) or 0)).cast("decimal(38,0)").alias(n) for n in names])


def _write(rows: DataFrame, root: str, table: str, batch_id: int, fmt: str) -> None:
    rows.write.format(fmt).mode("overwrite").save(f"{root}/{table}/{BATCH}={batch_id}")


def _together(spark: SparkSession, outputs: list[Callable[[], object]]) -> None:
    """Write a batch's outputs, of which none needs another, side by side; most are too small to fill a cluster."""
    with ThreadPoolExecutor(WRITERS) as pool:
        for written in [pool.submit(inheritable_thread_target(spark)(output)) for output in outputs]:
            written.result()


def _kept(rows: DataFrame, root: str, table: str, batch_id: int) -> DataFrame:
    """``rows`` written to the batch's folder and read again."""
    _write(rows, root, table, batch_id, "parquet")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{root}/{table}/{BATCH}={batch_id}")


def _log(spark: SparkSession, root: str, epoch_batches: int) -> DeltaLog:
    return DeltaLog(spark, f"{root}/state", ACTIVITY_SCHEMA, MARK_SCHEMA, PAIR_KEYS, epoch_batches)


def _stale(rows: DataFrame, retention: str) -> Column:
    newest = F.lit(rows.agg(F.max("timestamp")).first()[0])
    return F.col("timestamp") < newest - F.expr(f"INTERVAL {retention}")


def correlation_batch(root: str, threshold: int = KPI_THRESHOLD, fmt: str = "parquet",
                      epoch_batches: int = EPOCH_BATCHES, retention: str | None = None,
                      keep_events: bool = False) -> Batch:
    """What one micro-batch of message values does.

    The numbers of the batch's keys are added to those that are stored (marks), so a start finds
    ends of earlier batches as well as the other way round, and every later end finds its starts. Stored
    rows are read only for keys that are paired by this batch. Below ``root`` are written: the documents
    that are finished now, by day; the ``violations`` and the counts per trace (``traces``) that the batch adds;
    ``alarms``; ``rejects``; in ``state`` the rows of keys that are still unpaired, and the batch's marks; and, counted
    while the others are written, a row of ``batches``. With ``keep_events`` the rows that are paired now are
    written too (``events``), from which ``read_correlated`` gives every start and end with its links.

    When an epoch ends, stored rows of paired keys are left behind and closed days are merged.
    With ``retention``, an interval such as ``90 days``, open starts and orphan ends that are older
    than that at the end of an epoch, by the newest event of the epoch's last batch, move to
    ``state/expired``. By default all are kept.
    """

    def run(values: DataFrame, batch_id: int) -> None:
        spark = values.sparkSession
        log, counted, days = _log(spark, root, epoch_batches), _Counted(batch_id), DailyTargets(spark, root, fmt)
        parsed = parse_records(values).withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))).persist()
        events, rejects = split_parsed(parsed)
        acts = activities(events)
        unkeyed, rows, added = acts.where(~complete(PAIR_KEYS)), None, None
        try:
            # Small tables between the steps are files: steps stay short plans, and lost executors cost one step.
            fresh = log.add("marks", batch_id, key_marks(acts, threshold))
            after = _kept(marks_after(fresh, log.marks(batch_id, fresh.select(*PAIR_KEYS).distinct())), root, "state/after", batch_id)
            totals = _kept(key_totals(after), root, "state/keys", batch_id)
            rows = with_totals(acts, totals).persist()
            added = new_violations(after, totals).persist()
            # A filter over files lets Spark make a Bloom filter of the keys.
            flips = totals.where(f"{PAIRED} AND NOT ({WAS_PAIRED}) AND starts0 + ends0 > 0")
            stored = log.rows(batch_id, flips) if keep_events else log.rows(
                batch_id, flips.where("starts0 = 0"), f"eventType = '{ACTIVITY_END}'")
            docs = op.documents(counted("finished", newly_finished(rows, stored)), threshold)
            found = counted("violations", added)
            unpaired = counted("stored", rows.where(f"NOT ({PAIRED})"))
            bad, nowhere = counted("rejects", rejects.hint("rebalance")), counted("unkeyed", unkeyed.hint("rebalance"))
            outputs = [
                lambda: days.add(op.daily_documents(docs), batch_id, log.epoch(batch_id)),
                lambda: log.add("rows", batch_id, unpaired),
                lambda: _write(bad, root, "rejects", batch_id, fmt),
                lambda: _write(nowhere, root, "unkeyed", batch_id, fmt),
                lambda: _write(found, root, "violations", batch_id, fmt),
                lambda: _write(new_trace_counts(totals, unkeyed), root, "traces", batch_id, fmt),
                lambda: _write(op.alarm_messages(alarms_of(added, threshold)), root, "alarms", batch_id, fmt),
            ]
            if keep_events:
                here = rows.where(PAIRED).select(*ACTIVITY_COLUMNS).unionByName(stored.select(*ACTIVITY_COLUMNS))
                outputs.append(lambda: _write(here.hint("rebalance"), root, "events", batch_id, fmt))
            _together(spark, outputs)
            _write(counted.row(spark), root, "batches", batch_id, "parquet")
            if log.ends_epoch(batch_id):
                alive, base, gone = next_base(log, batch_id, threshold, _stale(acts, retention) if retention else None)
                if retention:
                    _write(gone, root, "state/expired", batch_id, "parquet")
                log.write_base(batch_id, alive, base)
                days.merge(log.epoch(batch_id))
        finally:
            for frame in (added, rows, parsed):
                if frame is not None:
                    frame.unpersist()

    return run


def _both_sides(instances: DataFrame) -> DataFrame:
    return instances.withColumn("side", F.explode(F.array(F.lit("s"), F.lit("e"))))


def _stale_instances(sides: DataFrame, retention: str) -> Column:
    """Whether the newest event of a rule and instance, on either side, is older than ``retention``."""
    newest = F.lit(sides.agg(F.max("timestamp")).first()[0])
    last = F.max("timestamp").over(Window.partitionBy("ruleKey", INSTANCE))  # two rows at most
    return last < newest - F.expr(f"INTERVAL {retention}")


def phases_batch(root: str, rules: DataFrame, fmt: str = "parquet", epoch_batches: int = EPOCH_BATCHES,
                 retention: str | None = None) -> Batch:
    """Phases by their latest start and end event, wherever these came.

    Stored is the latest event per rule, instance and side; a batch replaces those that it
    moves, and writes the phases of these instances anew. Without ``retention`` the state keeps every instance.
    With it, an interval such as ``90 days``, an instance whose events are all older than that when an epoch
    ends, by the newest phase event of the epoch's last batch, moves to ``phase_sides/expired``; events of it that come
    later begin it anew, while its phases stay in the target.
    """

    def run(values: DataFrame, batch_id: int) -> None:
        spark = values.sparkSession
        store = KeyedLog(spark, f"{root}/phase_sides", SIDE_SCHEMA, SIDE_KEYS, epoch_batches)
        parsed = parse_records(values).withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))).persist()
        events, rejects = split_parsed(parsed)
        fresh = newest_sides(phase_sides(events, rules)).persist()
        try:
            _write(rejects.hint("rebalance"), root, "phase_rejects", batch_id, fmt)
            moved = fresh.select("ruleKey", INSTANCE).distinct()
            sides = newest_sides(fresh.unionByName(store.read(batch_id, _both_sides(moved)))).persist()
            try:
                _write(latest_of(measured_sides(sides, rules)), root, "phases", batch_id, fmt)
                store.write(batch_id, sides)
            finally:
                sides.unpersist()
            if store.ends_epoch(batch_id):
                store.close_epoch(batch_id, _stale_instances(fresh, retention) if retention else None)
        finally:
            for frame in (fresh, parsed):
                frame.unpersist()

    return run


def _start(values: DataFrame, batch: Batch, checkpoint: str, trigger: str | None) -> StreamingQuery:
    writer = values.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    if trigger is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def run_correlation(values: DataFrame, root: str, checkpoint: str, threshold: int = KPI_THRESHOLD,
                    trigger: str | None = TRIGGER, fmt: str = "parquet",
                    retention: str | None = None, keep_events: bool = False) -> StreamingQuery:
    """Start the correlation job on a stream of message values.

    ``trigger`` is the batch interval; with None the job takes what is there and
    ends. Call ``awaitTermination`` on the result to run until stopped.
    """
    batch = correlation_batch(root, threshold, fmt, retention=retention, keep_events=keep_events)
    return _start(values, batch, checkpoint, trigger)


def run_phases(values: DataFrame, rules: DataFrame, root: str, checkpoint: str,
               trigger: str | None = TRIGGER, fmt: str = "parquet", retention: str | None = None) -> StreamingQuery:
    """Start the phase job on a stream of message values."""
    return _start(values, phases_batch(root, rules, fmt, retention=retention), checkpoint, trigger)


def run_batches(batches: Iterable[DataFrame], batch: Batch) -> None:
    """Run a job's micro-batch over finished sets of message values, one after the other."""
    for batch_id, values in enumerate(batches):
        batch(values, batch_id)


def _stored(spark: SparkSession, root: str, table: str, schema: T.StructType, fmt: str) -> DataFrame:
    rows = spark.read.format(fmt).schema(schema).load(f"{root}/{table}")
    return rows.select(*[f"`{c}`" for c in schema.fieldNames()])


def read_documents(spark: SparkSession, root: str, day: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Documents as the keyed daily targets hold them: the latest per day and id.

    For one ``day`` only its last generation and the batches since are listed.
    """
    return DailyTargets(spark, root, fmt).read(day)


def read_alarms(spark: SparkSession, root: str, threshold: int = KPI_THRESHOLD, fmt: str = "parquet") -> DataFrame:
    """The alarms of all batches together, as a finished set of the same events gives them."""
    return alarms_of(_stored(spark, root, "violations", VIOLATION_SCHEMA, fmt), threshold)


def _unkeyed(spark: SparkSession, root: str, before: int, fmt: str, table: str = "unkeyed") -> DataFrame:
    schema = T.StructType([*ACTIVITY_SCHEMA, T.StructField(BATCH, T.LongType())])
    rows = read_or_empty(spark, f"{root}/{table}", schema, fmt)
    return rows.where(F.col(BATCH) < before).select(*ACTIVITY_COLUMNS)


def read_unmatched(spark: SparkSession, root: str, before: int, epoch_batches: int = EPOCH_BATCHES,
                   fmt: str = "parquet") -> tuple[DataFrame, DataFrame]:
    """Open starts and orphan ends when batch ``before`` begins."""
    stored = unmatched_rows(_log(spark, root, epoch_batches), before).select(*ACTIVITY_COLUMNS)
    rows = stored.unionByName(_unkeyed(spark, root, before, fmt)).withColumn("matches", F.lit(0).cast("bigint"))
    return op.open_side(rows), op.orphan_side(rows)


def read_correlated(spark: SparkSession, root: str, before: int, epoch_batches: int = EPOCH_BATCHES,
                    fmt: str = "parquet") -> DataFrame:
    """Every start and end of the batches before ``before``, once, with the number of its ``matches`` on the
    other side and the time of the latest (``partnerTimestamp``), as ``correlated_events`` gives it.

    For a job with ``keep_events``. Finished rows come from its ``events``, open starts and orphan ends from the
    state; how many partners they have, and since when, the marks of their keys tell, so a hot key's rows
    are joined to one row.
    """
    log = _log(spark, root, epoch_batches)
    rows = _unkeyed(spark, root, before, fmt, "events").unionByName(
        unmatched_rows(log, before).select(*ACTIVITY_COLUMNS)
    ).unionByName(_unkeyed(spark, root, before, fmt))
    known = added_up(log.marks(before), PAIR_KEYS)
    counts = key_counts(known, PAIR_KEYS, _starts=F.first("starts"), _ends=F.first("ends"),
                        _lastStart=F.first("lastStart"), _lastEnd=F.first("lastEnd"))
    joined = join_key_counts(keyed_or_spread(rows, PAIR_KEYS), PAIR_KEYS, counts, "left_outer")
    other = lambda end, start: F.when(is_start(), F.col(end)).otherwise(F.col(start))
    return joined.select(
        *ACTIVITY_COLUMNS, F.coalesce(other("_ends", "_starts"), F.lit(0)).alias("matches"),
        other("_lastEnd", "_lastStart").alias("partnerTimestamp"),
    )


def read_trace_counts(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Finished pairs, open starts and orphan ends per process and trace, from what the batches added."""
    group = ["businessProcessName", TRACE_KEY]
    summed = _stored(spark, root, "traces", TRACE_SCHEMA, fmt).groupBy(*group).agg(
        *[F.sum(c).cast("decimal(38,0)").alias(c) for c in ("finished", "open", "orphan")]
    )
    return summed.where("finished <> 0 OR open <> 0 OR orphan <> 0")


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """What each batch counted of its outputs, by ``batch_id``."""
    fields = [T.StructField(name, T.DecimalType(38, 0)) for table in COUNTS.values() for name in table]
    return spark.read.schema(T.StructType([*fields, T.StructField(BATCH, T.LongType())])).parquet(f"{root}/batches")


def read_phases(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """Phases as the keyed target holds them: the latest per id."""
    return latest_of(_stored(spark, root, "phases", PHASE_SCHEMA, fmt))


def to_console(rows: DataFrame, limit: int = 20, truncate: bool = False) -> StreamingQuery:
    """Print the first rows of each micro-batch."""
    return (
        rows.writeStream.format("console")
        .option("numRows", limit)
        .option("truncate", truncate)
        .start()
    )
