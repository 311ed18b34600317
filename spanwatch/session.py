"""Session settings and the scratch folder for written intermediates."""

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A sorted join becomes a hash join where every build partition is below this size;
    # Spark asks that it is not below the advisory partition size.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.parquet.filterPushdown": "true",
    # From this size on a table is filtered by the keys it is joined with before it is shuffled.
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    # Join state goes to local RocksDB files with a change log, not to the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
LOCAL_SETTINGS = {
    "spark.driver.bindAddress": "127.0.0.1",
    "spark.driver.host": "127.0.0.1",
}


def build_session(app: str = "spanwatch", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; ``settings`` use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app)
    conf = dict(SETTINGS)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            conf.update(LOCAL_SETTINGS)
    conf.update({k.replace("__", "."): v for k, v in settings.items()})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application for a stateful stream.

    Such a stream keeps its number of state partitions for life, and each costs a
    commit per batch, so it is set for the stream alone: by default one per core.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", partitions or spark.sparkContext.defaultParallelism)
    for key, value in SETTINGS.items():
        if key.startswith("spark.sql.streaming."):
            own.conf.set(key, value)
    return own


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder path for tables a job writes and reads back.

    It lies in the shared folder that the cluster names in ``spark.checkpoint.dir``.
    Only a local session without that setting gets a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="spanwatch-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return os.path.join(shared, f"{name}-{uuid.uuid4().hex}")
