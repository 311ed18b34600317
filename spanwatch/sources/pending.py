"""State that the running jobs keep across batches, in tables of the output folder."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.operators.matching import join_key_counts, key_counts, keyed

BATCH = "batch_id"
EPOCH_BATCHES = 100
_BATCH_FIELD = T.StructField(BATCH, T.LongType())
_SETTINGS = T.StructType([T.StructField("epoch_batches", T.LongType())])


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
          base: str | None = None) -> DataFrame | None:
    """A table in files, or None where nothing was written."""
    reader = spark.read.format(fmt).schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                  base: str | None = None) -> DataFrame:
    """A table in files (below ``base``, where folders are columns), or an empty frame where nothing was written yet."""
    rows = _read(spark, path, schema, fmt, base)
    if rows is not None:
        return rows
    # Known to be empty when the query is planned, so joins to it are left out.
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return spark.range(0).select(*columns).where(F.lit(False))


class KeyedLog:
    """Rows by key, where what a batch writes for a key replaces all earlier rows of that key.

    A batch only ever writes its own folder and overwrites it when it is run again, so a
    retry leaves the same state. Every ``epoch_batches`` batches the whole state is written as
    the base of the next epoch, so a read lists one base and the folders of one epoch. A base
    that is missing, or another epoch length than the log began with, is an error: reading on
    would lose state.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str],
                 epoch_batches: int = EPOCH_BATCHES):
        self.spark, self.root, self.keys, self.epoch_batches = spark, root, keys, epoch_batches
        self.schema = T.StructType([*schema, _BATCH_FIELD])
        known = _read(spark, f"{root}/settings", _SETTINGS)
        began = None if known is None else known.first()
        if began is not None and began[0] != epoch_batches:
            raise ValueError(f"{root} has epochs of {began[0]} batches, not of {epoch_batches}")
        self._new = began is None

    def _epoch(self, epoch: int, before: int) -> DataFrame:
        log = read_or_empty(self.spark, f"{self.root}/log/epoch={epoch}", self.schema).where(F.col(BATCH) < before)
        if not epoch:
            return log
        base = _read(self.spark, f"{self.root}/base/epoch={epoch}", self.schema)
        if base is None:
            raise FileNotFoundError(f"{self.root}/base/epoch={epoch} is missing: the state before it is lost")
        return base.unionByName(log)

    def _state(self, epoch: int, before: int, keys: DataFrame | None = None) -> DataFrame:
        rows = self._epoch(epoch, before)
        if keys is not None:  # one row per key, so this join cannot multiply rows
            wanted = key_counts(keys, self.keys, _n=F.count(F.lit(1)))
            rows = join_key_counts(keyed(rows, self.keys), self.keys, wanted, "left_semi")
        last = key_counts(rows, self.keys, _last=F.max(BATCH))
        joined = join_key_counts(keyed(rows, self.keys), self.keys, last, "inner")
        return joined.where(F.col("_last") == F.col(BATCH)).drop("_last")

    def read(self, before: int, keys: DataFrame | None = None) -> DataFrame:
        """The rows when batch ``before`` begins; of ``keys`` only, if given."""
        return self._state(before // self.epoch_batches, before, keys).drop(BATCH)

    def write(self, batch_id: int, rows: DataFrame) -> None:
        """Replace the rows of all keys that ``rows`` has."""
        if self._new:
            settings = self.spark.range(1).select(F.lit(self.epoch_batches).cast("bigint").alias("epoch_batches"))
            settings.write.mode("overwrite").parquet(f"{self.root}/settings")
            self._new = False
        epoch = batch_id // self.epoch_batches
        path = f"{self.root}/log/epoch={epoch}/{BATCH}={batch_id}"
        rows.select(*[c for c in self.schema.fieldNames() if c != BATCH]).write.mode("overwrite").parquet(path)

    def ends_epoch(self, batch_id: int) -> bool:
        return not (batch_id + 1) % self.epoch_batches

    def close_epoch(self, batch_id: int, stale: Column | None = None) -> None:
        """After the last batch of an epoch, write the state as the base of the next.

        Rows for which ``stale`` holds go to ``expired`` instead; it may look at other rows by a window.
        """
        after = batch_id + 1
        if not self.ends_epoch(batch_id):
            return
        state = self._state(batch_id // self.epoch_batches, after)
        if stale is not None:
            state = state.withColumn("_gone", F.coalesce(stale, F.lit(False)))
            gone = state.where("_gone").drop(BATCH, "_gone")
            gone.write.mode("overwrite").parquet(f"{self.root}/expired/{BATCH}={batch_id}")
            state = state.where("NOT _gone").drop("_gone")
        state.write.mode("overwrite").parquet(f"{self.root}/base/epoch={after // self.epoch_batches}")
