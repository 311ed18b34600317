"""Counts per process and trace. No count needs the pairs themselves."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.operators.matching import key_counts
from spanwatch.operators.sides import ends, starts
from spanwatch.schema import END_KEYS, PAIR_KEYS, START_KEYS


def pair_counts(events: DataFrame) -> DataFrame:
    """Finished rows per pair key: starts times ends, both counted before they meet.

    The product is a decimal since a hot key can have more pairs than a bigint holds.
    """
    s = key_counts(starts(events), START_KEYS, _starts=F.count(F.lit(1)))
    e = key_counts(ends(events), END_KEYS, _ends=F.count(F.lit(1)))
    names = [f"_k{i}" for i in range(len(PAIR_KEYS))]
    wide = "decimal(19,0)"
    return s.join(e, names).select(
        *[F.col(n).alias(k) for n, k in zip(names, PAIR_KEYS)],
        (F.col("_starts").cast(wide) * F.col("_ends").cast(wide)).alias("count"),
    )


def trace_counts(rows: DataFrame, process: str, trace: str, weight: str | None = None) -> DataFrame:
    """Rows per process and trace; a null trace is a group of its own."""
    total = F.sum(weight) if weight else F.count(F.lit(1))
    return rows.groupBy(process, trace).agg(total.alias("count"))


def group_count(rows: DataFrame, process: str, trace: str) -> DataFrame:
    """How many groups ``trace_counts`` has, as one row. ``countDistinct`` would skip null traces."""
    return rows.groupBy(process, trace).count().agg(F.count(F.lit(1)).alias("groups"))


def violation_count(violating: DataFrame) -> DataFrame:
    """How many finished rows violate the limit, as one row; a decimal as in ``pair_counts``."""
    total = F.sum(F.col("matches").cast("decimal(19,0)"))
    return violating.agg(F.coalesce(total, F.lit(0)).alias("violations"))
