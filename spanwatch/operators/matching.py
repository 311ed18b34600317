"""Joining rows to the number of their matches instead of to the matches themselves.

A finished activity keeps its end's columns only, so all that a start adds is the
fact that it exists, and how often. Counting one side per key first leaves one row
per key. The join then cannot multiply rows, and only the other side can be skewed,
which adaptive execution splits.
"""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_HASH = "_keyHash"
BLOCK = 1000


def _all(conditions) -> Column:
    return reduce(and_, conditions)


def complete(keys: list[str]) -> Column:
    return _all(F.col(k).isNotNull() for k in keys)


def keyed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is complete, with the hash of the key as one more join key.

    The hash is equal wherever the keys are, so it changes no match. It makes the
    counted side be shuffled once more: adaptive execution can split a skewed
    partition only where both inputs of the join come straight from a shuffle.
    """
    return rows.where(complete(keys)).withColumn(KEY_HASH, F.xxhash64(*keys))


def keyed_or_spread(rows: DataFrame, keys: list[str]) -> DataFrame:
    """All rows. Those with a null key match nothing; their hash depends on the task that
    reads them, which spreads them, copies included, and needs no further column."""
    spread = F.xxhash64(F.spark_partition_id(), *keys)
    return rows.withColumn(KEY_HASH, F.when(complete(keys), F.xxhash64(*keys)).otherwise(spread))


def key_counts(rows: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """One row per key, under neutral key names ``_k0``...; rows with a null key are left out."""
    named = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    totals = [total.alias(name) for name, total in aggregates.items()]
    return rows.where(complete(keys)).groupBy(*named).agg(*totals)


def join_key_counts(hashed: DataFrame, keys: list[str], counts: DataFrame, how: str) -> DataFrame:
    """Join ``keyed`` rows to the ``key_counts`` of a side; the helper columns are dropped."""
    names = [f"_k{i}" for i in range(len(keys))]
    same_key = _all(F.col(k) == F.col(n) for k, n in zip(keys, names))
    counts = counts.withColumn("_hash", F.xxhash64(*names))
    joined = hashed.join(counts, same_key & (F.col(KEY_HASH) == F.col("_hash")), how)
    return joined.drop(*names, KEY_HASH, "_hash")


def without_match(rows: DataFrame, keys: list[str], other: DataFrame, other_keys: list[str]) -> DataFrame:
    """Rows whose key the other side does not have."""
    counts = key_counts(other, other_keys, _n=F.count(F.lit(1)))
    return join_key_counts(keyed_or_spread(rows, keys), keys, counts, "left_anti")


def with_matches(rows: DataFrame, keys: list[str], other: DataFrame, other_keys: list[str]) -> DataFrame:
    """Rows whose key the other side has, once each, with the number of ``matches``."""
    counts = key_counts(other, other_keys, matches=F.count(F.lit(1)))
    return join_key_counts(keyed(rows, keys), keys, counts, "inner")


def expand_matches(rows: DataFrame) -> DataFrame:
    """Repeat each row ``matches`` times and drop the column.

    Repeats are made block by block, so no row ever holds an array of more than
    one entry per thousand matches.
    """
    blocks = rows.withColumn("_block", F.explode(F.expr(f"sequence(0, (matches - 1) div {BLOCK})")))
    size = F.least(F.lit(BLOCK).cast("bigint"), F.col("matches") - F.col("_block") * BLOCK)
    repeat = F.explode(F.sequence(F.lit(1).cast("bigint"), size))
    return blocks.withColumn("_repeat", repeat).drop("matches", "_block", "_repeat")
