"""KPI check, result documents, and the keyed upsert."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.functions import day_name, document_id, kpi_text, kpi_value, utc_wall
from spanwatch.schema import IP_CHECK_KEY, TRACE_KEY

# The limit in milliseconds, the daily target's name, the document's columns.
KPI_THRESHOLD = 5000
INDEX_PREFIX = "bam-"
DOCUMENT_COLUMNS = [
    "@version",
    "@timestamp",
    "documentType",
    "eventType",
    "technicalOrigin",
    "businessOrigin",
    "businessProcessId",
    "businessProcessName",
    "businessProcessVersion",
    "businessProcessActivityId",
    "businessProcessActivityName",
    "businessProcessInstanceId",
    "durationInMillis",
    "payload",
    "id",
]


_OTHER_TYPES = {
    "@version": T.IntegerType(), "@timestamp": T.TimestampType(), "durationInMillis": T.LongType(),
    "payload": T.MapType(T.StringType(), T.StringType()),
}
DOCUMENT_SCHEMA = T.StructType([T.StructField(c, _OTHER_TYPES.get(c, T.StringType())) for c in DOCUMENT_COLUMNS])


def with_kpi(rows: DataFrame, threshold=KPI_THRESHOLD, duration: str = "durationInMillis") -> DataFrame:
    """Add ``kpiThresholdValue``, ``kpiStatusText`` and ``kpiStatusValue``.

    ``threshold`` is a number, or a column where each row has its own.
    """
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold).cast("bigint")
    return rows.withColumns(
        {
            "kpiThresholdValue": limit,
            "kpiStatusText": kpi_text(duration, limit),
            "kpiStatusValue": kpi_value(duration, limit),
        }
    )


def violations(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("kpiStatusText") == "NOK")


def documents(finished: DataFrame, threshold: int = KPI_THRESHOLD, source_tz: str = "UTC") -> DataFrame:
    """The result document of each finished activity; ``matches`` is kept where present."""
    payload = F.create_map(
        F.lit(TRACE_KEY), F.col(TRACE_KEY),
        F.lit(IP_CHECK_KEY), F.col(IP_CHECK_KEY),
        F.lit("kpiThresholdValue"), F.col("kpiThresholdValue").cast("string"),
        F.lit("kpiStatusText"), F.col("kpiStatusText"),
        F.lit("kpiStatusValue"), F.col("kpiStatusValue").cast("string"),
    )
    built = {
        "@version": F.col("version"),
        "@timestamp": F.to_utc_timestamp("timestamp", source_tz),
        "documentType": F.lit("correlated_event"),
        "payload": payload,
        "id": document_id("businessProcessName", "businessProcessActivityName", TRACE_KEY),
    }
    columns = [built[c].alias(c) if c in built else F.col(c) for c in DOCUMENT_COLUMNS]
    kept = ["matches"] if "matches" in finished.columns else []
    return with_kpi(finished, threshold).select(*columns, *kept)


def latest_first() -> list[Column]:
    """Order of the versions of one document: by time, then by every other value."""
    later = ["@timestamp", "durationInMillis"]
    rest = [c for c in DOCUMENT_COLUMNS if c not in [*later, "payload", "id"]]
    parts = [F.col(f"`{c}`") for c in rest] + [F.col("payload")[k] for k in (TRACE_KEY, IP_CHECK_KEY)]
    return [F.col(f"`{c}`").desc_nulls_last() for c in later] + [p.asc_nulls_last() for p in parts]


def first_per(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key. Spark keeps one row per key and task before the
    shuffle (window group limit), so a hot key reaches the reducer already reduced."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_documents(docs: DataFrame) -> DataFrame:
    """Keyed upsert: the latest version of each document id."""
    return first_per(docs.drop("matches"), ["id"], latest_first())


def daily_documents(docs: DataFrame, prefix: str = INDEX_PREFIX) -> DataFrame:
    """The latest version of each id within its day, with the day (``doc_date``) and its target."""
    dated = docs.drop("matches").withColumns(
        {"doc_date": utc_wall("`@timestamp`").cast("date"), "target": day_name(prefix, F.col("`@timestamp`"))}
    )
    return first_per(dated, ["doc_date", "id"], latest_first())
