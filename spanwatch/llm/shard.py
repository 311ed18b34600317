"""Sharding into contiguous shards of equal bytes."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanwatch.llm.prefix import with_prefix
from spanwatch.llm.scratch import documents, free_names, settle

SHARDS = 40
ROW_BYTES = 16


def text_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


def shard_by_bytes(rows: DataFrame, shards: int, order: list[Column], size: str) -> DataFrame:
    """Add ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in its shard).

    The rows, in ``order``, are cut at equal targets of the running sum of ``size``: a row
    goes where its middle lies, so a shard differs from the mean by one row's size at
    most. Null sizes count as 0; if all are 0, the rows are cut by number. Equal rows are
    placed one after another; an empty table stays empty. Other columns pass through; a
    ``shard`` or ``slot`` column of the input is replaced.
    """
    rows = rows.drop("shard", "slot")
    weight, before, place, first, shard = free_names(rows.columns, "weight", "before", "place", "first", "cut")
    amount = F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long"))
    placed = settle(with_prefix(rows.withColumn(weight, amount), order, weight, before, place))
    total, number = placed.agg(F.sum(weight), F.count(F.lit(1))).first()
    if total:
        middle = F.expr(f"(2 * `{before}` + `{weight}`) * {shards} div {2 * total}")
    else:
        middle = F.expr(f"`{place}` * {shards} div {max(number, 1)}")
    cut = placed.withColumn(shard, F.least(middle, F.lit(shards - 1)).cast("int"))
    firsts = cut.groupBy(F.col(shard).alias("shard")).agg(F.min(place).alias(first))
    return (
        cut.join(F.broadcast(firsts), F.col(shard) == F.col("shard"))  # at most ``shards`` rows
        .withColumn("slot", F.col(place) - F.col(first))
        .drop(weight, before, place, first, shard)
    )


def sharded_rows(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``, cut in the order of doc_id and a hash of the text.

    Only keys and sizes are ordered; texts move once, to meet their places. Rows that agree in
    doc_id and text take the places of their group in turn.
    """
    docs = docs.drop("shard", "slot")
    digest, turn, doc, j_digest, j_turn = free_names(
        [*docs.columns, "shard", "slot", "size"], "digest", "turn", "j_doc", "j_digest", "j_turn"
    )
    numbered = docs.withColumn(digest, F.xxhash64("text")).withColumn(
        turn, F.row_number().over(Window.partitionBy("doc_id", digest).orderBy(F.lit(1)))
    )
    keys = numbered.select("doc_id", digest, turn, (text_bytes(F.col("text")) + ROW_BYTES).alias("size"))
    placed = shard_by_bytes(settle(keys), shards, [F.col(c) for c in ("doc_id", digest, turn)], "size").select(
        F.col("doc_id").alias(doc), F.col(digest).alias(j_digest), F.col(turn).alias(j_turn), "shard", "slot"
    )
    same = (
        numbered["doc_id"].eqNullSafe(F.col(doc)) & (F.col(digest) == F.col(j_digest)) & (F.col(turn) == F.col(j_turn))
    )
    return numbered.join(placed, same).select(*docs.columns, "shard", "slot")


def op8_shard_by_bytes(spark, sf_dir) -> DataFrame:
    sized = documents(spark, sf_dir).select(
        "doc_id",
        (text_bytes(F.col("text")) + ROW_BYTES).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return shard_by_bytes(settle(sized), SHARDS, order, "size").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
