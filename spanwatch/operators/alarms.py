"""Alarms: the violating document ids of each process and activity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.functions import fill_template, kpi_text
from spanwatch.operators.documents import KPI_THRESHOLD

PAGE_IDS = 1000

# The subject and the text of an alarm.
SUBJECT = "[BAM, alarm!] for Process Name [#!processName#]"
TEMPLATE = """Subject: #!subject#

The business process #!processName# has generated the following alarm:

------------------------------------------

Process Name         : #!processName#
Activity Name        : #!phaseName#
Ids                  : #!processInstanceIds#
KPI Threshold Limit  : #!threshold#

------------------------------------------

This message was delivered to you by BAM, alarm!"""


def _violating(docs: DataFrame, threshold: int) -> DataFrame:
    return docs.where(kpi_text("durationInMillis", threshold) == "NOK")


def alarm_ids(docs: DataFrame, threshold: int = KPI_THRESHOLD) -> DataFrame:
    """Ids of the violating documents, each with the number of its violations (``matches``)."""
    return _violating(docs, threshold).select("id", "matches")


def alarms(docs: DataFrame, threshold: int = KPI_THRESHOLD, page_ids: int = PAGE_IDS) -> DataFrame:
    """Alarm rows per process and activity name.

    Each violating id is listed once, with the number of its violations at the same
    place in ``occurrences``. A group with many ids is spread by the hash of the id
    over as many pages as it needs for about ``page_ids`` ids each, so no task and
    no text ever holds a whole group.
    """
    return alarms_of(_violating(docs, threshold).withColumn("n", F.col("matches")), threshold, page_ids)


def alarms_of(violations: DataFrame, threshold: int = KPI_THRESHOLD, page_ids: int = PAGE_IDS) -> DataFrame:
    """Alarm rows from violations counted per process, activity name and ``id`` (``n``, summed up here)."""
    group = ["businessProcessName", "businessProcessActivityName"]
    per_id = violations.groupBy(*group, "id").agg(F.sum(F.col("n").cast("decimal(19,0)")).alias("n"))
    sizes = per_id.groupBy(*[F.col(c).alias(f"_{c}") for c in group]).agg(
        F.ceil(F.count(F.lit(1)) / page_ids).alias("pages"), F.sum("n").alias("allViolations")
    )
    same_group = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group]
    bits = F.conv(F.substring(F.md5("id"), 1, 15), 16, 10).cast("bigint")
    paged = per_id.join(sizes, same_group).withColumn("page", bits % F.col("pages"))
    listed = F.array_sort(F.collect_list(F.struct("id", "n")))
    rows = paged.groupBy(*group, "page").agg(
        listed.alias("listed"),
        F.sum("n").alias("violations"),
        *[F.first(c).alias(c) for c in ("pages", "allViolations")],
    )
    return rows.select(
        fill_template(SUBJECT, {"processName": F.col("businessProcessName")}).alias("subject"),
        F.col("businessProcessName").alias("processName"),
        F.col("businessProcessActivityName").alias("phaseName"),
        (F.col("page") + 1).alias("page"),
        "pages",
        F.array_join("listed.id", " ").alias("processInstanceIds"),
        F.array_join(F.col("listed.n").cast("array<string>"), " ").alias("occurrences"),
        "violations",
        "allViolations",
        F.lit(threshold).cast("bigint").alias("threshold"),
    )


def alarm_messages(alarm_rows: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Alarm rows with the filled message text."""
    names = ("subject", "processName", "phaseName", "processInstanceIds", "threshold")
    return alarm_rows.withColumn("message", fill_template(template, {n: F.col(n) for n in names}))
