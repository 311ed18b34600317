"""Global prefix sums without a global sort in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanwatch.llm.scratch import free_names, settle


def with_prefix(df: DataFrame, order: list[Column], value: str, before: str, rank: str) -> DataFrame:
    """Add the sum of ``value`` and the number of rows that precede each row in ``order``.

    Rows are dealt by ranges of ``order`` and written once. One total per partition
    is summed over the partitions (as many rows as partitions), and each partition
    adds its own running sum. ``order`` should tell rows apart: equal rows share a
    range, whatever their number. Null values count as 0.
    """
    part, ahead, rows = free_names([*df.columns, before, rank], "part", "ahead", "rows")
    amount = F.coalesce(F.col(value).cast("long"), F.lit(0).cast("long"))
    dealt = settle(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))
    earlier = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        dealt.groupBy(F.col(part).alias("p"))
        .agg(F.sum(amount).alias("s"), F.count(F.lit(1)).alias("n"))
        .select(
            F.col("p").alias(part),
            F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias(ahead),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(rows),
        )
    )
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.join(totals, part)
        .withColumn(before, F.col(ahead) + F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .withColumn(rank, F.col(rows) + F.count(F.lit(1)).over(within))
        .drop(part, ahead, rows)
    )
