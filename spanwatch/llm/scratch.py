"""Written intermediates and column names that cannot clash."""

import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def use_shared_folder(spark: SparkSession) -> None:
    """Point checkpoints at the folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of this machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="spanwatch-")
    context.setCheckpointDir(shared)


def settle(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder: cut lineage, fixed rows, safe from lost executors."""
    use_shared_folder(df.sparkSession)
    return df.checkpoint()


def compact(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """``df`` settled for a loop, and read in partitions of about ``rows`` rows if it has more partitions.

    Tables that turn out small so cost few tasks and files, whatever the number of shuffle
    partitions. A checkpoint hands on the size that the optimizer had guessed, and guesses of
    joins multiply from round to round; so the rows come back as a new table without one.
    """
    df = settle(df)
    few = 1 + df.count() // rows
    if few < partitions(df):
        df = df.coalesce(few)
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.toJavaRDD(), df._jdf.schema()), spark)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner see which frames of a loop are gone, so that it deletes their shuffles and checkpoints.

    The driver's collector runs seldom by itself, and a loop's disk would grow with its rounds.
    """
    spark._jvm.System.gc()


def partitions(df: DataFrame) -> int:
    return max(1, df._jdf.rdd().getNumPartitions())


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as Parquet to the shared folder and read again, and its path."""
    use_shared_folder(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``written`` made."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted`` names, prefixed until none equals a column of ``taken`` (case aside)."""
    used = {name.lower() for name in taken}
    out = []
    for name in wanted:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def small_batches(spark: SparkSession) -> None:
    """Let Arrow carry 1,000 rows at a time, where the session does not say how many (Spark: 10,000).

    A batch of texts is held several times, by the JVM and by a Python worker for every core.
    """
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, "1000")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text of ``docs``, for a function over Arrow batches."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("string").alias("text"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
