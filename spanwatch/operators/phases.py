"""Phases: the time from one activity's event to another's in one process instance."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.functions import millis_between, phase_id
from spanwatch.operators.documents import first_per, with_kpi
from spanwatch.schema import EVENT_COLUMNS, EVENT_SCHEMA, RULES_SCHEMA, prefixed

INSTANCE = "businessProcessInstanceId"
SIDE_COLUMNS = [c for c in EVENT_COLUMNS if c != INSTANCE]
SIDE_KEYS = ["ruleKey", INSTANCE, "side"]
SIDE_SCHEMA = T.StructType([
    T.StructField("side", T.StringType()), T.StructField("ruleKey", T.LongType()),
    T.StructField("businessProcessPhaseName", T.StringType()), *EVENT_SCHEMA,
])
PHASE_SCHEMA = T.StructType(
    [T.StructField(INSTANCE, T.StringType())]
    + [T.StructField(prefixed(side, c), EVENT_SCHEMA[c].dataType) for side in "se" for c in SIDE_COLUMNS]
    + [T.StructField("businessProcessPhaseName", T.StringType()), T.StructField("id", T.StringType())]
    + [T.StructField(c, T.LongType()) for c in ("durationInMillis", "kpiThresholdValue")]
    + [T.StructField("kpiStatusText", T.StringType()), T.StructField("kpiStatusValue", T.IntegerType())]
    + [T.StructField("documentType", T.StringType())]
)


def phase_events(events: DataFrame, rules: DataFrame, sides: str = "se") -> DataFrame:
    """Events that begin (``side`` = ``s``) or finish (``e``) a phase, with their ``rule``.

    One join serves all rules. Rules are configuration; Spark broadcasts them as long
    as they are below its size threshold.
    """
    rule = F.struct(*[F.col(c) for c in RULES_SCHEMA.fieldNames()]).alias("rule")
    wanted_kinds = F.array(
        *[
            F.struct(
                F.lit(side).alias("side"),
                F.col(f"{name}ActivityId").alias("_activity"),
                F.col(f"{name}Type").alias("_type"),
            )
            for side, name in (("s", "start"), ("e", "end"))
            if side in sides
        ]
    )
    wanted = rules.distinct().select(
        rule, F.col("businessProcessName").alias("_process"), F.inline(wanted_kinds)
    )
    same_kind = (
        (F.col("businessProcessName") == F.col("_process"))
        & (F.col("businessProcessActivityId") == F.col("_activity"))
        & (F.col("eventType") == F.col("_type"))
    )
    return events.join(wanted, same_kind).select("side", "rule", *EVENT_COLUMNS)


def phase_sides(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Phase events under a short ``ruleKey`` in place of the rule; those without an instance match nothing."""
    return (
        phase_events(events, rules).where(F.col(INSTANCE).isNotNull())
        .select(
            "side", rule_key("rule").alias("ruleKey"),
            F.col("rule.businessProcessPhaseName").alias("businessProcessPhaseName"), *EVENT_COLUMNS,
        )
    )


def rule_key(rule: str) -> Column:
    """64-bit hash of all fields of a rule. The phase name is compared beside it."""
    return F.xxhash64(*[F.col(f"{rule}.{c}") for c in RULES_SCHEMA.fieldNames()])


def _side(sides: DataFrame, side: str) -> DataFrame:
    return sides.where(F.col("side") == side).select(
        F.col("ruleKey").alias(f"_{side}Key"),
        F.col("businessProcessPhaseName").alias(f"_{side}Phase"),
        F.col(INSTANCE).alias(f"_{side}Instance"),
        *[F.col(c).alias(prefixed(side, c)) for c in SIDE_COLUMNS],
    )


def _checked(rows: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """KPI columns by each rule's own threshold, which is looked up by the rule's key."""
    limits = rules.distinct().select(
        F.xxhash64(*RULES_SCHEMA.fieldNames()).alias("_limitKey"), F.col("threshold").alias("_threshold")
    )
    joined = rows.join(limits, F.col(key) == F.col("_limitKey"))
    return (
        with_kpi(joined, F.col("_threshold")).drop("_threshold", "_limitKey", key)
        .withColumn("documentType", F.lit("phase_event"))
    )


def measured_sides(sides: DataFrame, rules: DataFrame, within: str | None = None) -> DataFrame:
    """Every pair of a start and an end event among ``sides``, measured and checked against its rule."""
    s, e = _side(sides, "s"), _side(sides, "e")
    same = (
        (F.col("_sKey") == F.col("_eKey")) & (F.col("_sInstance") == F.col("_eInstance"))
        & F.col("_sPhase").eqNullSafe(F.col("_ePhase"))
    )
    if within is not None:
        gap = F.expr(f"INTERVAL {within}")
        same &= F.col("eTimestamp").between(F.col("sTimestamp") - gap, F.col("sTimestamp") + gap)
    paired = s.join(e, same).select(
        F.col("_sInstance").alias(INSTANCE),
        *[prefixed("s", c) for c in SIDE_COLUMNS],
        *[prefixed("e", c) for c in SIDE_COLUMNS],
        F.col("_sPhase").alias("businessProcessPhaseName"),
        phase_id("_sPhase", "_sInstance").alias("id"),
        millis_between("sTimestamp", "eTimestamp").alias("durationInMillis"),
        "_sKey",
    )
    return _checked(paired, rules, "_sKey")


def phases(events: DataFrame, rules: DataFrame, within: str | None = None) -> DataFrame:
    """Every pair of a phase's start and end event: m times n rows for an instance with m starts and n ends.

    ``phase_ends`` and ``latest_phases`` have bounded results. ``within`` limits the distance
    in time, which a stream needs to free its state.
    """
    return measured_sides(phase_sides(events, rules), rules, within)


def phase_ends(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Each end event of a phase once, measured from the latest start of its instance, with the number of starts.

    Starts are reduced to one row per rule and instance before the join.
    """
    sides = phase_sides(events, rules)
    s = sides.where("side = 's'").groupBy(
        F.col("ruleKey").alias("_key"), F.col(INSTANCE).alias("_instance")
    ).agg(F.max("timestamp").alias("sTimestamp"), F.count(F.lit(1)).alias("matches"))
    e = _side(sides, "e")
    joined = e.join(s, (F.col("_eKey") == F.col("_key")) & (F.col("_eInstance") == F.col("_instance"))).select(
        F.col("_eInstance").alias(INSTANCE),
        "sTimestamp",
        *[prefixed("e", c) for c in SIDE_COLUMNS],
        F.col("_ePhase").alias("businessProcessPhaseName"),
        phase_id("_ePhase", "_eInstance").alias("id"),
        millis_between("sTimestamp", "eTimestamp").alias("durationInMillis"),
        "matches",
        "_eKey",
    )
    return _checked(joined, rules, "_eKey")


def _newest(side: str) -> list[Column]:
    """Order of one side's events: by time, then by every other value."""
    name = lambda c: prefixed(side, c) if side else c
    rest = [c for c in SIDE_COLUMNS if c not in ("timestamp", "payload")]
    payload = F.array_sort(F.map_entries(F.col(name("payload"))))
    return (
        [F.col(name("timestamp")).desc_nulls_last()]
        + [F.col(name(c)).asc_nulls_last() for c in rest]
        + [payload.asc_nulls_last()]
    )


def newest_sides(sides: DataFrame) -> DataFrame:
    """The latest event per rule, instance and side."""
    return first_per(sides, SIDE_KEYS, _newest(""))


def latest_phases(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Keyed upsert of the phases: per id the one with the latest end, then the latest start.

    The latest pair of an instance is its latest end with its latest start, so each
    side is reduced to one row per rule and instance before the join.
    """
    return latest_of(measured_sides(newest_sides(phase_sides(events, rules)), rules))


def latest_of(measured: DataFrame) -> DataFrame:
    """The latest measurement of each phase id."""
    # Only rules with the same phase name can still tie; then the smaller threshold stays.
    ties = [F.col(c).asc_nulls_last() for c in ("businessProcessPhaseName", INSTANCE, "kpiThresholdValue")]
    return first_per(measured, ["id"], _newest("e") + _newest("s") + ties)
