"""State that grows by what a batch adds: rows of keys, and marks that add up to what is known of a key."""

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanwatch.sources.pending import BATCH, EPOCH_BATCHES, read_or_empty

_BATCH_FIELD = T.StructField(BATCH, T.LongType())
_SETTINGS = T.StructType([T.StructField("epoch_batches", T.LongType())])
_CURRENT = T.StructType([T.StructField("run", T.StringType()), T.StructField("buckets", T.LongType())])


class DeltaLog:
    """Rows by key, and ``marks``: small rows per key whose numbers add up over the batches.

    A batch appends its own rows and marks and never writes an earlier row again, however many
    a key has. It overwrites its own folders when it is run again, so a retry leaves the same state.
    Which rows still count, the marks of their keys tell; the others fall away at the epoch's end, every
    ``epoch_batches`` batches, when rows and marks are written as the base of the next epoch. A base is
    written to a folder of its own and then named as the current one, so that a run that breaks off leaves
    nothing half done. A base that is missing, or another epoch length than the log began with, is an
    error: reading on would lose state.

    The base's marks are a table bucketed and sorted by key, so that a join with a batch's keys
    shuffles the batch's side alone. It has as many buckets as ``spark.sql.shuffle.partitions`` says
    when it is written.
    """

    def __init__(self, spark: SparkSession, root: str, rows: T.StructType, marks: T.StructType, keys: list[str],
                 epoch_batches: int = EPOCH_BATCHES):
        self.spark, self.root, self.keys, self.epoch_batches = spark, root, keys, epoch_batches
        self.schemas = {"rows": rows, "marks": marks}
        began = read_or_empty(spark, f"{root}/settings", _SETTINGS).first()
        if began is not None and began[0] != epoch_batches:
            raise ValueError(f"{root} has epochs of {began[0]} batches, not of {epoch_batches}")
        self._new = began is None
        self._bases: dict[int, tuple[str, int]] = {}

    def epoch(self, batch_id: int) -> int:
        return batch_id // self.epoch_batches

    def _log(self, table: str, before: int, epoch: int) -> DataFrame:
        schema = T.StructType([*self.schemas[table], _BATCH_FIELD])
        log = read_or_empty(self.spark, f"{self.root}/{table}/epoch={epoch}", schema)
        return log.where(F.col(BATCH) < before).drop(BATCH)

    def _base_path(self, epoch: int) -> tuple[str, int]:
        if epoch not in self._bases:
            current = read_or_empty(self.spark, f"{self.root}/base/epoch={epoch}/current", _CURRENT).first()
            if current is None:
                raise FileNotFoundError(f"{self.root}/base/epoch={epoch} is missing: the state before it is lost")
            self._bases[epoch] = f"{self.root}/base/epoch={epoch}/{current['run']}", current["buckets"]
        return self._bases[epoch]

    def _base_rows(self, epoch: int) -> DataFrame | None:
        if not epoch:
            return None
        path, _ = self._base_path(epoch)
        return self.spark.read.schema(self.schemas["rows"]).parquet(f"{path}/rows")

    def _base_marks(self, epoch: int) -> DataFrame | None:
        """The bucketed table, which another session may have to be told of first."""
        if not epoch:
            return None
        path, buckets = self._base_path(epoch)
        name = _table(path)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schemas["marks"])
            keys = ", ".join(f"`{k}`" for k in self.keys)
            location = path.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                f"INTO {buckets} BUCKETS LOCATION '{location}/marks'"
            )
        return self.spark.table(name)

    def marks(self, before: int, keys: DataFrame | None = None, epoch: int | None = None) -> DataFrame:
        """All marks when batch ``before`` begins, still to be added up; of ``keys`` (each once) only, if given.

        ``epoch`` is that of the batch, or the one before it, whose base and batches say the same.
        """
        epoch = self.epoch(before) if epoch is None else epoch
        parts = [p for p in (self._base_marks(epoch), self._log("marks", before, epoch)) if p is not None]
        if keys is not None:
            wanted = keys.select(*self.keys)
            parts = [p.join(wanted, self.keys) for p in parts]
        names = self.schemas["marks"].fieldNames()
        return _union([p.select(*names) for p in parts])

    def rows(self, before: int, keys: DataFrame | None = None, only: str = "true", epoch: int | None = None) -> DataFrame:
        """All rows when batch ``before`` begins, those that no longer count included, as far as
        condition ``only`` holds; if ``keys`` (each once) are given those of them, with the columns of ``keys``.

        Keys that were read from files with a filter let Spark drop other rows by a Bloom filter
        before it shuffles them, from the table size on that its settings name.
        """
        epoch = self.epoch(before) if epoch is None else epoch
        parts = [p.where(only) for p in (self._base_rows(epoch), self._log("rows", before, epoch)) if p is not None]
        return _union(parts if keys is None else [p.join(keys, self.keys) for p in parts])

    def add(self, table: str, batch_id: int, frame: DataFrame) -> DataFrame:
        """Write what the batch adds to ``rows`` or ``marks``, and read it from there."""
        if self._new:
            settings = self.spark.range(1).select(F.lit(self.epoch_batches).cast("bigint").alias("epoch_batches"))
            settings.write.mode("overwrite").parquet(f"{self.root}/settings")
            self._new = False
        path = f"{self.root}/{table}/epoch={self.epoch(batch_id)}/{BATCH}={batch_id}"
        frame.select(*self.schemas[table].fieldNames()).write.mode("overwrite").parquet(path)
        return self.spark.read.schema(self.schemas[table]).parquet(path)

    def ends_epoch(self, batch_id: int) -> bool:
        return not (batch_id + 1) % self.epoch_batches

    def write_base(self, batch_id: int, rows: DataFrame, marks: DataFrame) -> None:
        """After an epoch's last batch: what the next epoch starts from."""
        epoch = self.epoch(batch_id + 1)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        run = f"run-{uuid.uuid4().hex}"
        path = f"{self.root}/base/epoch={epoch}/{run}"
        rows.select(*self.schemas["rows"].fieldNames()).write.parquet(f"{path}/rows")
        dealt = marks.select(*self.schemas["marks"].fieldNames()).repartition(buckets, *self.keys)
        writer = dealt.write.format("parquet").option("path", f"{path}/marks")
        writer.bucketBy(buckets, *self.keys).sortBy(*self.keys).saveAsTable(_table(path))
        self._switch(epoch, run, buckets)

    def _switch(self, epoch: int, run: str, buckets: int) -> None:
        named = self.spark.range(1).select(F.lit(run).alias("run"), F.lit(buckets).cast("bigint").alias("buckets"))
        named.write.mode("overwrite").parquet(f"{self.root}/base/epoch={epoch}/current")
        self._bases.pop(epoch, None)


def _table(path: str) -> str:
    return "spanwatch_" + hashlib.md5(path.encode()).hexdigest()


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
