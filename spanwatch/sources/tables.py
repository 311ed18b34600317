"""The driver's ``events`` table seen as process events."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.functions import iso_utc
from spanwatch.schema import ACTIVITY_END, ACTIVITY_START, EVENT_COLUMNS, IP_CHECK_KEY, TRACE_KEY

# How the table's event types stand for activity events.
TYPE_OF = {"view": ACTIVITY_START, "purchase": ACTIVITY_END}


def as_process_events(events: DataFrame, activity: Column | None = None) -> DataFrame:
    user = F.col("user_id")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    is_end = F.col("event_type") == "purchase"
    event_type = F.upper("event_type")
    for name, mapped in TYPE_OF.items():
        event_type = F.when(F.col("event_type") == name, mapped).otherwise(event_type)

    def label(prefix: str, n: int):
        return F.concat(F.lit(prefix), (user % n).cast("string"))

    instance = F.concat(user.cast("string"), F.lit("-"), F.col("k").cast("string"))
    ip_check = F.when(
        is_end & (F.col("k") % 3 != 0), F.when(F.col("k") % 2 == 0, "YES").otherwise("NO")
    )
    duration = F.round(F.col("value") * 100).cast("bigint")
    return events.withColumn("k", k).select(
        F.lit(1).alias("version"),
        F.col("ts").alias("timestamp"),
        F.lit("bam_event").alias("documentType"),
        event_type.alias("eventType"),
        label("host-", 4).alias("technicalOrigin"),
        label("BO-", 10).alias("businessOrigin"),
        label("process-", 5).alias("businessProcessId"),
        label("process-", 5).alias("businessProcessName"),
        F.lit("1.0.0").alias("businessProcessVersion"),
        (label("activity-", 3) if activity is None else activity).alias("businessProcessActivityId"),
        F.when(F.col("k") % 2 == 1, label("step-", 3)).alias("businessProcessActivityName"),
        instance.alias("businessProcessInstanceId"),
        F.when(is_end, duration).otherwise(F.lit(0).cast("bigint")).alias("durationInMillis"),
        F.create_map(
            F.lit(TRACE_KEY), F.when(F.col("k") % 25 != 0, instance),
            F.lit(IP_CHECK_KEY), ip_check,
        ).alias("payload"),
    )


def process_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of the table."""
    return as_process_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def activity_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts and ends only, with the type test on the stored column so that it reaches the scan."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return as_process_events(events.where(F.col("event_type").isin(*TYPE_OF)))


def phase_rules(spark: SparkSession, end_activity: Column | None = None) -> DataFrame:
    """One rule for each of the table's 5 processes and 3 activities; it ends with ``end_activity``
    of the rule's ``id``, or with the activity it begins with."""
    p, a = F.expr("id div 3").cast("string"), (F.col("id") % 3).cast("string")
    activity = F.concat(F.lit("activity-"), a)
    return spark.range(15).select(
        F.concat(F.lit("process-"), p).alias("businessProcessName"),
        F.concat(F.lit("phase-"), p, F.lit("-"), a).alias("businessProcessPhaseName"),
        activity.alias("startActivityId"),
        F.lit(ACTIVITY_START).alias("startType"),
        (activity if end_activity is None else end_activity).alias("endActivityId"),
        F.lit(ACTIVITY_END).alias("endType"),
        F.lit(100).cast("bigint").alias("threshold"),
    )


def crossing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts and ends whose activity varies within an instance."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type").isin(*TYPE_OF))
    activity = F.concat(F.lit("activity-"), (F.col("event_id") % 3).cast("string"))
    return as_process_events(events, activity)


def crossing_rules(spark: SparkSession) -> DataFrame:
    """Rules whose phases end with the activity after the one they begin with."""
    follower = F.concat(F.lit("activity-"), ((F.col("id") + 1) % 3).cast("string"))
    return phase_rules(spark, follower)


def as_json_values(events: DataFrame) -> DataFrame:
    """Event records written as JSON text, the form in which a topic carries them."""
    return events.select(
        F.to_json(
            F.struct(
                F.col("version").alias("@version"),
                iso_utc("timestamp").alias("@timestamp"),
                *[c for c in EVENT_COLUMNS if c not in ("version", "timestamp")],
            )
        ).alias("value")
    )
