"""Physical plans: what reaches the scan, what is shuffled, and how skew is handled."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from spanwatch import operators as op
from spanwatch.plans import QUERIES
from spanwatch.session import work_dir
from spanwatch.sources.tables import activity_events

SF_DIR = "/root/testdata/sf0.01"


def plan(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    old = {}

    def put(**options):
        for name, value in options.items():
            name = name.replace("__", ".")
            old[name] = spark.conf.get(name, None)
            spark.conf.set(name, value)

    yield put
    for name, value in old.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def test_type_filter_and_needed_columns_reach_the_scan(spark):
    text = plan(QUERIES["q_open_per_trace"](spark, SF_DIR))
    assert text.count("PushedFilters: [In(event_type, [purchase,view])") == 2
    schemas = re.findall(r"ReadSchema: (\S+)", text)
    assert len(schemas) == 2 and all("value" not in s and "ts:" not in s for s in schemas)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("q_stream")))
def test_no_query_needs_python_cross_joins_or_single_partitions(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Scan ExistingRDD"):
        assert word not in text
    if name not in ("q_violation_count", "q_group_counts"):
        assert "SinglePartition" not in text


def test_rank_is_cut_before_the_shuffle(spark):
    text = plan(QUERIES["q_documents_latest"](spark, SF_DIR))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    first, second = (m.start() for m in re.finditer("WindowGroupLimit", tree))
    assert "Exchange" in tree[first:second]


def test_scans(spark):
    """All classes come from one pass over the rows and one over the keys."""
    scans = lambda name: plan(QUERIES[name](spark, SF_DIR)).split("\n\n")[0].count("Scan parquet")
    assert scans("q_correlated") == 2
    assert scans("q_group_counts") == 6  # two for the classes, four for the two batches of the resolved ones
    assert scans("q_phases") == 2


def test_a_rule_is_shuffled_as_one_number(spark):
    text = plan(QUERIES["q_phases_latest"](spark, SF_DIR))
    assert "hashpartitioning(ruleKey" in text and not re.findall(r"hashpartitioning\([^)]*rule#", text)


def test_payload_map_is_not_built_for_keys(spark):
    text = plan(QUERIES["q_starts_without_end"](spark, SF_DIR))
    assert "map(spp_trace_wf_id" not in text


def test_unmatched_rows_reuse_the_shuffles_of_the_pair_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    frame = op.correlated(activity_events(spark, SF_DIR))
    frame.collect()
    assert plan(frame).split("Initial Plan")[0].count("+- ReusedExchange") == 2


HOT = 200_000


def hot_events(spark):
    """One key with two starts and most of the ends, and one end each for other keys."""
    i = F.col("id")
    key = F.when(i < HOT, F.lit("hot")).otherwise(i.cast("string"))
    return spark.range(0, HOT + 20_000, 1, 8).select(
        F.lit(1).alias("version"),
        F.timestamp_seconds(i).alias("timestamp"),
        F.lit("bam_event").alias("documentType"),
        F.when(i < 2, "ACTIVITY_START").otherwise("ACTIVITY_END").alias("eventType"),
        F.sha2(i.cast("string"), 256).alias("technicalOrigin"),
        *[F.lit("x").alias(c) for c in (
            "businessOrigin", "businessProcessId", "businessProcessName", "businessProcessVersion",
            "businessProcessActivityId", "businessProcessActivityName", "businessProcessInstanceId")],
        F.lit(1).cast("bigint").alias("durationInMillis"),
        F.create_map(F.lit("spp_trace_wf_id"), key).alias("payload"),
    )


def hot_phases(events):
    """The hot key is the hot instance of a phase here; rules come by a shuffle join as well."""
    instance = F.col("payload")["spp_trace_wf_id"]
    rule = "SELECT 'x' businessProcessName, 'ph' businessProcessPhaseName, 'x' startActivityId, " \
        "'ACTIVITY_START' startType, 'x' endActivityId, 'ACTIVITY_END' endType, 100L threshold"
    rows = events.withColumn("businessProcessInstanceId", instance)
    return op.phases(rows, events.sparkSession.sql(rule)).drop("sPayload", "ePayload")


@pytest.mark.parametrize(
    "operator, rows",
    [(hot_phases, 2 * (HOT - 2)), (op.finished, HOT - 2), (op.ends_without_start, 20_000), (op.classify, HOT + 20_000),
     (op.correlated, 2 * (HOT - 2) + 20_000)],
)
def test_a_hot_key_is_split(spark, conf, tmp_path, operator, rows):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__shuffle__partitions="16",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1m",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="2m",
    )
    hot_events(spark).write.parquet(str(tmp_path / "hot"))
    frame = operator(spark.read.parquet(str(tmp_path / "hot")))
    frame = frame.agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*frame.columns)).alias("h")
    )
    assert frame.first().n == rows
    frame.collect()
    assert "skew=true" in plan(frame).split("Initial Plan")[0]


def test_null_keys_do_not_share_a_partition(spark, make_events):
    from spanwatch.operators.matching import KEY_HASH, keyed_or_spread
    from spanwatch.schema import START_KEYS

    copies = make_events(*[("START", None)] * 400).repartition(8)
    hashes = keyed_or_spread(op.starts(copies), START_KEYS).select(KEY_HASH).distinct().count()
    assert hashes == 8


class Session:
    """Just what ``work_dir`` asks a session for; the setting itself is fixed at start-up."""

    def __init__(self, master, checkpoint_dir=None):
        self.conf = {"spark.checkpoint.dir": checkpoint_dir}
        self.sparkContext = self
        self.master = master

    def getCheckpointDir(self):
        return None


def test_work_dir_follows_the_cluster_setting():
    assert work_dir(Session("yarn", "hdfs://c/shared"), "x").startswith("hdfs://c/shared/x-")
    assert work_dir(Session("local[4]"), "x") != work_dir(Session("local[4]"), "x")
    with pytest.raises(RuntimeError):
        work_dir(Session("yarn"), "x")


def delta_log(spark, root, stored=2000):
    """A log whose base holds so many orphan ends, one per key, and a batch since with ten more."""
    from spanwatch.schema import PAIR_KEYS
    from spanwatch.sources import DeltaLog
    from spanwatch.streaming.state import ACTIVITY_SCHEMA, MARK_SCHEMA

    log = DeltaLog(spark, str(root), ACTIVITY_SCHEMA, MARK_SCHEMA, PAIR_KEYS, 2)
    frames = [stored_keys(spark.range(stored), schema) for schema in (ACTIVITY_SCHEMA, MARK_SCHEMA)]
    log.write_base(1, *frames)
    for table, frame in zip(("rows", "marks"), frames):
        log.add(table, 2, frame.limit(10))
    return log


def stored_keys(ids, schema):
    values = {"businessProcessName": F.lit("p"), "businessProcessActivityId": F.lit("a"), "spp_trace_wf_id": F.col("id").cast("string"),
              "eventType": F.lit("ACTIVITY_END"), "starts": F.lit(0), "starts0": F.lit(0), "ends": F.lit(1)}
    return ids.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def above(text, scan):
    """Operators between a scan and the join above it."""
    lines = text.split("\n\n")[0].split("\n")
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth, found = len(re.match(r"[\s:|+\-*]*", lines[at]).group()), []
    for line in reversed(lines[:at]):
        here = len(re.match(r"[\s:|+\-*]*", line).group())
        if here < depth:
            depth = here
            found.append(line.strip(" :+-*"))
            if "Join" in line:
                return found
    raise AssertionError("no join")


def test_a_batch_does_not_shuffle_the_base(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    log = delta_log(spark, tmp_path)
    keys = log.marks(3).select("businessProcessName", "businessProcessActivityId", "spp_trace_wf_id").where("spp_trace_wf_id < '1'").distinct()
    frame = log.marks(3, keys)
    with contextlib.redirect_stdout(io.StringIO()) as text:
        frame.explain()
    path = above(text.getvalue(), "FileScan parquet spark_catalog.default.spanwatch_")
    assert "SortMergeJoin" in path[-1] and not any("Exchange" in node for node in path)
    assert frame.count() == 2  # the key '0' in base and batch


def test_stored_rows_pass_a_bloom_filter_before_they_are_shuffled(spark, conf, tmp_path):
    from spanwatch.streaming.state import KEY_SCHEMA

    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold="1b")
    log = delta_log(spark, tmp_path / "log")
    stored_keys(spark.range(20), KEY_SCHEMA).write.parquet(str(tmp_path / "paired"))
    flips = spark.read.schema(KEY_SCHEMA).parquet(str(tmp_path / "paired")).where("starts0 = 0")
    frame = log.rows(3, flips, "eventType = 'ACTIVITY_END'")
    text = plan(frame)
    tree = text.split("\n\n")[0]
    assert len(re.findall(r"Condition : .*might_contain\(Subquery.*xxhash64\(spp_trace_wf_id", text)) == 2
    assert re.search(r"Exchange \(\d+\)\n[ :|]*\+- (\* )?Filter", tree)
    assert frame.count() == 30
