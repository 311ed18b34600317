"""The daily targets of the documents: batches by epoch, closed days merged into one generation each."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch import operators as op
from spanwatch.operators.documents import DOCUMENT_COLUMNS, DOCUMENT_SCHEMA
from spanwatch.sources.pending import BATCH, read_or_empty

DAY, EPOCH = "doc_date", "epoch"
_MERGED = T.StructType([
    T.StructField(DAY, T.DateType()), T.StructField("run", T.StringType()), T.StructField("merged_before", T.LongType()),
])
_LOG = T.StructType([*DOCUMENT_SCHEMA, T.StructField(DAY, T.DateType()), T.StructField(EPOCH, T.LongType()),
                     T.StructField(BATCH, T.LongType())])
_BASE = T.StructType([*DOCUMENT_SCHEMA, T.StructField(DAY, T.DateType()), T.StructField("run", T.StringType())])


class DailyTargets:
    """Documents by day below ``root``.

    A batch adds a folder to each day it has documents for: ``documents/doc_date=D/epoch=E/batch_id=N``.
    When an epoch ends, days that are closed and have new folders are merged: their latest documents are
    written to ``merged/doc_date=D/run=R``, and a new list of merged days names run and epoch. Whoever reads takes the
    last list, the run that it names for a day, and the folders of the epochs after it. So a run that breaks off before
    the list is written changes nothing, and a reader never sees half of a merge. Late documents of a merged day lie
    in later epochs, and the day is merged once more. Nothing is deleted: folders that the last list no longer
    needs may be removed once no reader is left that began before it.
    """

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, f"{root}/daily", fmt

    def add(self, docs: DataFrame, batch_id: int, epoch: int) -> None:
        """Write a batch's documents; even a day that holds most of them is spread over several files (rebalance)."""
        rows = docs.withColumns({EPOCH: F.lit(epoch), BATCH: F.lit(batch_id)}).hint("rebalance", DAY)
        writer = rows.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(DAY, EPOCH, BATCH).save(f"{self.root}/documents")

    def _lists(self) -> DataFrame:
        schema = T.StructType([*_MERGED, T.StructField(EPOCH, T.LongType())])
        return read_or_empty(self.spark, f"{self.root}/lists", schema)

    def last_list(self) -> tuple[DataFrame, int]:
        """Merged days (doc_date, run, merged_before), and the epoch that the last list was written for: 0 without any."""
        lists = self._lists()
        last = lists.agg(F.max(EPOCH)).first()[0] or 0
        return lists.where((F.col(EPOCH) == last) & F.col(DAY).isNotNull()).drop(EPOCH), last

    def _folders(self, pattern: str) -> DataFrame:
        base = f"{self.root}/documents"
        return read_or_empty(self.spark, f"{base}/{pattern}", _LOG, self.fmt, base)

    def _run(self, pattern: str) -> DataFrame:
        base = f"{self.root}/merged"
        return read_or_empty(self.spark, f"{base}/{pattern}", _BASE, self.fmt, base)

    def _unmerged(self, merged: DataFrame) -> DataFrame:
        """Rows of the epochs that a day's merge does not hold."""
        since = merged.select(F.col(DAY).alias("_day"), "merged_before")
        rows = self._folders("*").join(since, F.col(DAY) == F.col("_day"), "left")
        return rows.where(F.col(EPOCH) >= F.coalesce("merged_before", F.lit(0))).drop("_day", "merged_before")

    def _generations(self, merged: DataFrame) -> DataFrame:
        """Rows of the runs that the list names."""
        named = merged.select(F.col(DAY).alias("_day"), F.col("run").alias("_run"))
        return self._run("*").join(named, (F.col(DAY) == F.col("_day")) & (F.col("run") == F.col("_run")), "left_semi")

    def read(self, day: str | None = None) -> DataFrame:
        """The latest document per day and id. For one ``day`` only its generation and the batches since are listed."""
        merged, last = self.last_list()
        if day is None:
            parts = [self._generations(merged), self._unmerged(merged)]
        else:
            known = merged.where(F.col(DAY) == F.lit(day).cast("date")).first()
            since = known["merged_before"] if known else 0
            epochs = ",".join(str(e) for e in range(since, last + 1))
            parts = [self._folders(f"doc_date={day}/epoch={{{epochs}}}")]
            if known:
                parts.append(self._run(f"doc_date={day}/run={known['run']}"))
        columns = [f"`{c}`" for c in DOCUMENT_COLUMNS]
        rows = parts[0].select(*columns)
        for part in parts[1:]:
            rows = rows.unionByName(part.select(*columns))
        return op.daily_documents(rows)

    def merge(self, epoch: int, open_days: int = 1) -> None:
        """At the end of ``epoch``: merge the days with new folders that lie ``open_days`` or more before the newest."""
        merged, last = self.last_list()
        if last > epoch:  # the batch is run again after its switch
            merged = self._lists().where((F.col(EPOCH) == epoch) & F.col(DAY).isNotNull()).drop(EPOCH)
        fresh = self._unmerged(merged).where(F.col(EPOCH) <= epoch)
        newest = fresh.agg(F.max(DAY)).first()[0]
        run = self.write_generation(fresh, merged, newest, open_days) if newest is not None else None
        self._switch(epoch, merged, run)

    def write_generation(self, fresh: DataFrame, merged: DataFrame, newest, open_days: int) -> str:
        """Write closed days with ``fresh`` rows as a new run; which nobody reads before the switch."""
        closed = fresh.where(F.col(DAY) <= F.date_sub(F.lit(newest), open_days))
        days = closed.select(F.col(DAY).alias("_day")).distinct()
        before = self._generations(merged).join(days, F.col(DAY) == F.col("_day"), "left_semi")
        columns = [f"`{c}`" for c in DOCUMENT_COLUMNS]
        run = uuid.uuid4().hex
        rows = op.daily_documents(closed.select(*columns).unionByName(before.select(*columns))).drop("target")
        rows.withColumn("run", F.lit(run)).hint("rebalance", DAY).write.format(self.fmt).mode("append").partitionBy(
            DAY, "run"
        ).save(f"{self.root}/merged")
        return run

    def _switch(self, epoch: int, merged: DataFrame, run: str | None) -> None:
        """The list for the next epoch: one row per merged day, in one file that appears as a whole."""
        path = f"{self.root}/lists/{EPOCH}={epoch + 1}"
        rows = merged
        if run is not None:
            new = self._run(f"*/run={run}").select(DAY, "run").distinct().withColumn("merged_before", F.lit(epoch + 1).cast("bigint"))
            kept = merged.join(new.select(F.col(DAY).alias("_day")), F.col(DAY) == F.col("_day"), "left_anti")
            rows = kept.unionByName(new)
        # A row without a day, so that a list without days is seen as well.
        mark = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _MERGED])
        rows.unionByName(mark).coalesce(1).write.mode("overwrite").parquet(path)
