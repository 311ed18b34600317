"""Mixing sources to target weights by capped water-filling."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanwatch.llm.prefix import with_prefix
from spanwatch.llm.scratch import documents, free_names, settle
from spanwatch.llm.text import word_count

# Weights of the registered query, in the order of the sources.
CYCLE = [5, 2, 1]
MAX_EPOCHS = 3
SEED = 20


def _share(left: int, weight: int) -> Column:
    """A source's part of ``left``, shared by weights that sum to ``weight``.

    In doubles: the product of words and a weight does not fit an int from some gigabytes on,
    and Spark ends such a query.
    """
    return F.lit(float(left)) * F.col("weight").cast("double") / F.lit(float(weight))


def source_targets(sources: DataFrame, max_epochs: int, budget: int | None = None) -> DataFrame:
    """Share ``budget`` over ``sources`` (source, source_size, weight) by weight.

    No target exceeds ``max_epochs`` times its source's size: sources above are clamped
    and the excess is shared again by weight until none is above. A round moves three
    numbers to the driver, whatever the number of sources. Null or non-positive weights
    get a target of 0. Without ``budget`` all sizes are shared.
    """
    sources = settle(sources.withColumn("cap", F.col("source_size") * max_epochs))
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = total if budget is None else budget
    weighted = F.coalesce(F.col("weight"), F.lit(0)) > 0
    level, clamped, left, weight = None, -1, 0, 0
    while True:
        above = F.lit(False) if level is None else F.col("cap") <= _share(left, weight)
        now = sources.filter(weighted).agg(
            F.sum(above.cast("long")).alias("n"),
            F.sum(F.when(above, F.col("cap"))).alias("cap"),
            F.sum(F.when(~above, F.col("weight"))).alias("weight"),
        ).first()
        if (now["n"] or 0) == clamped or not now["weight"]:
            break
        clamped, left, weight = now["n"] or 0, budget - (now["cap"] or 0), now["weight"]
        level = left / weight
    share = _share(left, weight) if weight else F.lit(0.0)
    target = F.least(F.col("cap").cast("double"), share)
    if not now["weight"]:
        target = F.col("cap").cast("double")
    return sources.withColumn("target", F.when(weighted, target).otherwise(0.0)).drop("cap")


def mix_sources(
    sized: DataFrame, weights: DataFrame, max_epochs: int = MAX_EPOCHS, seed: int = SEED, budget: int | None = None
) -> DataFrame:
    """Number of times each row of ``sized`` (doc_id, source, size) enters the mix.

    ``weights`` has (source, weight); sources without one are left out. Every row of a
    source is taken floor(target / source_size) times; the rest goes to the first rows
    in an order drawn by ``seed``, as many as come nearest to the target in size. Adds
    source_size, target, repetitions, taken = size * repetitions. Null sources are one
    source; equal rows are taken one by one; a source of size 0 is not taken; an empty
    table gives an empty one. Columns beyond the three are not read.
    """
    sized = settle(sized.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size")))
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    w = weights.select(F.col("source").alias("w_source"), "weight")
    targets = source_targets(
        totals.join(w, F.col("source").eqNullSafe(F.col("w_source")), "left").drop("w_source"), max_epochs, budget
    )
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))
    placed = settle(with_prefix(
        sized.withColumn("draw", draw),
        [F.col(c) for c in ("source", "draw", "doc_id", "size")], "size", "before", "place",
    ))
    starts = placed.groupBy("source").agg(F.min("before").alias("start"))
    # Settled, so that the join below has two plain sides: the rows of a hot source can be split.
    known = settle(targets.join(
        starts.withColumnRenamed("source", "s_source"), F.col("source").eqNullSafe(F.col("s_source"))
    ).select(F.col("source").alias("t_source"), "source_size", "target", "start"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # A row belongs to the fractional repetition if its middle lies before the cut.
    extra = (F.col("before") - F.col("start") + F.col("size") / 2) < (
        (F.col("rate") - F.floor("rate")) * F.col("source_size")
    )
    return (
        placed.join(known, F.col("source").eqNullSafe(F.col("t_source")))
        .withColumn("rate", rate)
        .withColumn("repetitions", (F.floor("rate") + extra.cast("long")).cast("long"))
        .withColumn("taken", F.col("size") * F.col("repetitions"))
        .select("doc_id", "source", "size", "source_size", "target", "repetitions", "taken")
    )


def mixed_rows(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """Each row of ``docs`` as often as ``mixed`` (from ``mix_sources``) says, with its own columns only.

    ``mixed`` must come from ``sized_documents(docs)``. Rows that agree in doc_id, source and
    size take the numbers of their group in turn.
    """
    names = free_names(docs.columns, "m_doc", "m_source", "m_size", "m_turn", "repetitions", "size", "turn", "copy")
    m_doc, m_source, m_size, m_turn, times, size, turn, copy = names
    group = ["doc_id", "source", "size"]
    alike = not mixed.groupBy(*group).count().filter("count > 1").isEmpty()
    docs_columns = docs.columns
    docs = docs.withColumn(size, word_count(F.col("text")))
    number = F.lit(1)
    if alike:
        number = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("repetitions")))
        own = Window.partitionBy("doc_id", "source", size).orderBy(F.xxhash64("text"))
        docs = docs.withColumn(turn, F.row_number().over(own))
    else:
        docs = docs.withColumn(turn, F.lit(1))
    counts = mixed.withColumn("turn", number).filter("repetitions > 0").select(
        *[F.col(c).alias(n) for c, n in zip([*group, "turn", "repetitions"], [m_doc, m_source, m_size, m_turn, times])]
    )
    same = (
        docs["doc_id"].eqNullSafe(F.col(m_doc)) & docs["source"].eqNullSafe(F.col(m_source))
        & (docs[size] == F.col(m_size)) & (docs[turn] == F.col(m_turn))
    )
    repeated = F.explode(F.array_repeat(F.lit(0), F.col(times).cast("int"))).alias(copy)
    return docs.join(counts, same).select(*docs_columns, repeated).select(docs_columns)


def cycled_weights(sized: DataFrame, cycle: list[int]) -> DataFrame:
    """Sources by code point, null last, with the weights of ``cycle`` in turn."""
    names = sized.select("source").distinct().withColumn("one", F.lit(1))
    ranked = with_prefix(names, [F.col("source").asc_nulls_last()], "one", "before", "place")
    turn = F.array(*[F.lit(x) for x in cycle])
    return ranked.select("source", F.element_at(turn, (F.col("place") % len(cycle) + 1).cast("int")).alias("weight"))


def sized_documents(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


def op1_mix_sources(spark, sf_dir) -> DataFrame:
    sized = settle(sized_documents(documents(spark, sf_dir)))
    mixed = mix_sources(sized, cycled_weights(sized, CYCLE))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "repetitions")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM d GROUP BY source
), o AS (
  SELECT *, (SELECT sum(source_size) FROM s)
            - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST
                                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w,
         row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS i
  FROM s
), f AS (
  SELECT rest, w, i FROM o WHERE 3 * source_size > rest * weight / w ORDER BY i LIMIT 1
), t AS (
  SELECT s.source, s.source_size,
         least(CAST(3 * s.source_size AS DOUBLE),
               coalesce((SELECT CAST(rest AS BIGINT) * s.weight / CAST(w AS BIGINT) FROM f), 3 * s.source_size)) AS target
  FROM s
), p AS (
  SELECT d.*, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
         coalesce(sum(size) OVER (PARTITION BY d.source
                                  ORDER BY md5(concat('20:', CAST(doc_id AS VARCHAR))), doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), r AS (
  SELECT *, CAST(floor(rate) + CASE WHEN before + size / 2 < (rate - floor(rate)) * source_size THEN 1 ELSE 0 END
                 AS BIGINT) AS repetitions FROM p
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(size * repetitions AS BIGINT) AS taken, repetitions FROM r
"""
