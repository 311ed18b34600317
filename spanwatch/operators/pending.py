"""Open starts of earlier batches and the ends that resolve them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.operators.correlate import finished_columns
from spanwatch.operators.matching import (
    join_key_counts,
    key_counts,
    keyed_or_spread,
    with_matches,
    without_match,
)
from spanwatch.schema import END_COLUMNS, END_KEYS, START_KEYS


def resolve_pending(pending: DataFrame, orphans: DataFrame) -> DataFrame:
    """Orphan ends that have an open start: finished rows with the number of ``matches``."""
    return with_matches(orphans, END_KEYS, pending, START_KEYS).select(*finished_columns(), "matches")


def still_pending(pending: DataFrame, orphans: DataFrame) -> DataFrame:
    """Open starts that none of the orphan ends resolves."""
    return without_match(pending, START_KEYS, orphans, END_KEYS)


def unresolved_ends(pending: DataFrame, orphans: DataFrame) -> DataFrame:
    """Orphan ends without an open start."""
    return without_match(orphans, END_KEYS, pending, START_KEYS)


def look_up(pending: DataFrame, orphans: DataFrame) -> DataFrame:
    """All orphan ends with the number of open starts they match, from one join.

    ``resolved_side``, ``unresolved_side`` and ``resolved_keys`` read their part of it.
    """
    counts = key_counts(pending, START_KEYS, _opened=F.count(F.lit(1)))
    joined = join_key_counts(keyed_or_spread(orphans, END_KEYS), END_KEYS, counts, "left_outer")
    matches = F.coalesce("_opened", F.lit(0).cast("bigint"))
    return joined.select(*END_COLUMNS, matches.alias("matches"))


def resolved_side(looked_up: DataFrame) -> DataFrame:
    return looked_up.where("matches > 0").select(*finished_columns(), "matches")


def unresolved_side(looked_up: DataFrame) -> DataFrame:
    return looked_up.where("matches = 0").select(*END_COLUMNS)


def resolved_keys(looked_up: DataFrame) -> DataFrame:
    """The keys, once each, whose open starts are resolved."""
    keys = [F.col(e).alias(s) for e, s in zip(END_KEYS, START_KEYS)]
    return looked_up.where("matches > 0").select(*keys).distinct()
