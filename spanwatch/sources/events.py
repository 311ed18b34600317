"""JSON event messages: reading them from Kafka or files, and parsing them."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.functions import utc_wall
from spanwatch.schema import EVENT_FIELDS, EVENT_SCHEMA

CORRUPT = "_corrupt"
# Every scalar is read as text and cast afterwards, so that quoted numbers and
# times in milliseconds are understood.
RAW_SCHEMA = T.StructType(
    [
        T.StructField(json_name, t if isinstance(t, T.MapType) else T.StringType())
        for _, json_name, t in EVENT_FIELDS
    ]
    + [T.StructField(CORRUPT, T.StringType())]
)


class EventBatch(NamedTuple):
    events: DataFrame
    rejects: DataFrame


def _kafka_options(topics: str, servers: str, options: dict) -> dict:
    return {"subscribe": topics, "kafka.bootstrap.servers": servers, **options}


def read_values(spark: SparkSession, path: str | None = None, *, topics: str | None = None,
                servers: str | None = None, **options) -> DataFrame:
    """Message values of a finished set: a folder of JSON lines, or a range of Kafka topics."""
    if topics:
        source = spark.read.format("kafka").options(**_kafka_options(topics, servers, options)).load()
        return source.select(F.col("value").cast("string").alias("value"))
    return spark.read.options(**options).text(path)


def stream_values(spark: SparkSession, path: str | None = None, *, topics: str | None = None,
                  servers: str | None = None, **options) -> DataFrame:
    """Message values as a stream. ``topics`` is a comma-separated list; the key is dropped."""
    if topics:
        source = (
            spark.readStream.format("kafka").options(**_kafka_options(topics, servers, options)).load()
        )
        return source.select(F.col("value").cast("string").alias("value"))
    return spark.readStream.options(**options).text(path)


def raw_records(records: DataFrame) -> DataFrame:
    """Partition, offset and text of each record of a Kafka-shaped frame."""
    return records.select("partition", "offset", F.col("value").cast("string").alias("value"))


def raw_file_records(spark: SparkSession, path: str) -> DataFrame:
    """The same listing for files, where the file stands for the partition."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), "value")


def _whole(text: Column, type_name: str) -> Column:
    """Text as a whole number: fractions are cut, blank is zero, nonsense is null."""
    number = text.try_cast("decimal(38,6)").try_cast(type_name)
    return F.when(F.trim(text) == "", F.lit(0).cast(type_name)).otherwise(number)


def _event_time(text: Column) -> Column:
    """Digits are epoch milliseconds; other text is ISO-8601, in UTC unless it names an offset."""
    text = F.trim(text)
    dated = F.substring(text, 5, 1) == "-"
    offset = F.regexp_replace(text, r"([T ].*[+-]\d{2})(\d{2})$", "$1:$2")
    clock = F.regexp_replace(offset, r"([T ][0-9:.]+)$", "$1Z")
    iso = F.regexp_replace(clock, r"^(\d{4}-\d{2}-\d{2})$", "$1T00:00:00Z")
    # The first case is the usual form and needs no pattern.
    return (
        F.when(dated & text.endswith("Z"), F.try_to_timestamp(text))
        .when(dated, F.try_to_timestamp(iso))
        .when(text.rlike(r"^-?\d{1,15}$"), F.timestamp_millis(text.try_cast("bigint")))
    )


def parse_records(values: DataFrame) -> DataFrame:
    """Message values as event columns, with the text and the ``reason`` of a reject (else null)."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    # As a generator the parser runs once per record. As a plain column it would be
    # copied into every filter on the fields that is pushed below it.
    fields = F.inline(F.array(F.from_json("value", RAW_SCHEMA, options)))
    record = values.select("value", fields)
    columns, bad_number = [], F.lit(False)
    for name, json_name, data_type in EVENT_FIELDS:
        field = F.col(f"`{json_name}`")
        if isinstance(data_type, (T.IntegerType, T.LongType)):
            number = _whole(field, data_type.simpleString())
            bad_number = bad_number | (field.isNotNull() & number.isNull())
            field = F.coalesce(number, F.lit(0).cast(data_type))
        elif isinstance(data_type, T.TimestampType):
            field = _event_time(field)
        columns.append(field.alias(name))
    malformed = (
        F.col("value").isNull()
        | ~F.ltrim(F.col("value"), F.lit(" \t\r\n")).startswith("{")
        | F.col(CORRUPT).isNotNull()
    )
    reason = (
        F.when(malformed, "malformed")
        .when(bad_number, "number")
        .when(_event_time(F.col("`@timestamp`")).isNull(), "timestamp")
    )
    return record.select(*columns, "value", reason.alias("reason"))


def split_parsed(parsed: DataFrame) -> EventBatch:
    return EventBatch(
        parsed.where("reason IS NULL").drop("value", "reason"),
        parsed.where("reason IS NOT NULL").select("value", "reason"),
    )


def parse_events(values: DataFrame) -> EventBatch:
    """Split message values into event records and rejects (``value``, ``reason``).

    One bad record never fails the job. A record is rejected when it is not a JSON
    object, when a number is none, or when it has no usable time.
    """
    return split_parsed(parse_records(values))


def write_events(events: DataFrame, path: str) -> None:
    """Store parsed events by day, so that several reports need not parse the JSON again.

    Rows are in order of type within a file: a filter on ``eventType`` skips row groups.
    """
    dated = events.withColumn("eventDate", utc_wall("timestamp").cast("date")).hint("rebalance", "eventDate")
    ordered = dated.sortWithinPartitions("eventDate", "eventType")
    ordered.write.mode("overwrite").partitionBy("eventDate").parquet(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Stored events, with ``eventDate`` as the partition column."""
    dated = T.StructType([*EVENT_SCHEMA, T.StructField("eventDate", T.DateType())])
    return spark.read.schema(dated).parquet(path)
