"""Connected components by repeated minimum labels."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanwatch.llm.scratch import compact, partitions


def components(edges: DataFrame) -> DataFrame:
    """The smallest id that each end of ``edges`` (a, b) can reach, as (id, label).

    Every round gives a node the least label among its neighbours and then the label of
    that label, so a chain shortens by half. Both steps reduce by key before a shuffle.
    Null ends are ignored.
    """
    edges = edges.dropna(subset=["a", "b"]).filter("a <> b")
    both = compact(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    parts = partitions(both)
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
    labels = compact(labels.select("id", F.least("id", "label").alias("label")).coalesce(parts))
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b").coalesce(parts)
            .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near")).coalesce(parts)
        )
        # A node also lowers the label of the node that labels it.
        told = labels.join(near, "id").select("id", "label", "near").coalesce(parts)
        offers = told.select("id", F.least("label", "near").alias("label")).union(
            told.filter("near < label").select(F.col("label").alias("id"), F.col("near").alias("label"))
        ).groupBy("id").agg(F.min("label").alias("label")).coalesce(parts)
        jump = offers.select(F.col("id").alias("label"), F.col("label").alias("further"))
        new = compact(
            offers.join(jump, "label", "left").select("id", F.coalesce("further", "label").alias("label"))
            .coalesce(parts)
        )
        old = labels.select("id", F.col("label").alias("old"))
        moved = not new.join(old, "id").filter("label < old").isEmpty()
        labels = new
        if not moved:
            return labels
