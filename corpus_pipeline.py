"""From raw documents to shards: five stages, each by one operator of ``spanwatch.llm``."""

from pyspark.sql import DataFrame, SparkSession

from spanwatch.llm import decontam, mix, neardup, scratch, shard, toxicity

SIMILARITY_PERCENT = 80
SHARDS = 40


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score lies below the threshold; the model is fitted on ``docs`` and the labels."""
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near-duplicates."""
    return neardup.first_of_each(docs, SIMILARITY_PERCENT)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks, never more than MAX_EPOCHS times."""
    sized = scratch.settle(mix.sized_documents(docs))
    return mix.mixed_rows(docs, mix.mix_sources(sized, mix.cycled_weights(sized, mix.CYCLE)))


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return shard.sharded_rows(docs, SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", cut_shards),
]

# The stages' models and sketches have no SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: each but the last is written as Parquet and read again."""
    docs, before = scratch.documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        docs, path = scratch.written(stage(spark, docs, sf_dir), name)
        if before:
            scratch.remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
