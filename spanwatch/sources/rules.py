"""Phase rules."""

from pyspark.sql import DataFrame, SparkSession

from spanwatch.schema import RULES_SCHEMA


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from a JSON array file. Spark knows the file's size, so it broadcasts
    the rules only while they are below ``spark.sql.autoBroadcastJoinThreshold``."""
    return spark.read.schema(RULES_SCHEMA).option("multiLine", True).json(path)
