"""Tables written to the shared folder, so that lost executors cost no more than their own tasks."""

from __future__ import annotations

from typing import Any

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

from millrace.session import remove_scratch, scratch_path, shared_dir


_made: list[str] = []  # tables of the stages so far, oldest first


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back: cuts the lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    _made.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, needed: DataFrame) -> None:
    """Removes the tables that ``stored`` has written so far, but for those that ``needed`` reads.

    For a flow whose steps each write their result before the next one begins.
    """
    files = needed.inputFiles()
    kept = [path for path in _made if any(path in f for f in files)]
    remove_scratch(spark, *[path for path in _made if path not in kept and path.startswith(f"{shared_dir(spark)}/")])
    _made[:] = kept


BATCH_ROWS = 1000


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or it with underscores before it, so that no column of ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name = f"_{name}"
    return name

MAX_TASKS = 10_000


def spread(work: DataFrame, *columns: str, pieces: int) -> DataFrame:
    """Rows that each stand for much work, dealt by ``columns`` to a task for each of their ``pieces``.

    The rows themselves are few and small, so without a given number adaptive execution would put all in one task.
    """
    return work.repartition(max(1, min(pieces, MAX_TASKS)), *columns)


def never_sent(df: DataFrame) -> DataFrame:
    """``df`` for a join by sorting, whatever its size is taken for.

    A table that comes from an explode is taken for as small as it was before, so Spark would gather it on the driver
    to broadcast it, although it has many times the rows. Hot keys of such a join are split by adaptive execution.
    """
    return df.hint("merge")


def small_batches(spark: SparkSession) -> None:
    """Texts are long rows: tasks hand fewer of them to Python at once than Spark's default of 10,000."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(spark: SparkSession, value: Any) -> Broadcast:
    """``value`` for the tasks, together with the code of its class; of a size that the caller has bounded."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(sent: Broadcast) -> Any:
    """What ``shipped`` sent, unpickled once in each worker."""
    if not hasattr(sent, "_opened"):
        sent._opened = cloudpickle.loads(sent.value)
    return sent._opened
