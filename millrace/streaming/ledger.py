"""Which micro-batches have landed, and what they touched."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import remove_scratch, scratch_path
from millrace.sinks.tables import in_partitions, overwrite, partition_values, replace_partitions, write_partitioned
from millrace.sources.files import from_rows, read_table

SCHEMA = "stream string, batch_id long, state string, day string, n long, at timestamp"
BEGUN, LANDED = "begun", "landed"
FOLD_FILES = 200  # entries written one by one, after which they become one file
BATCH = "batch"


def ledger_of(table: str) -> str:
    return f"{table.rstrip('/')}-ledger"


class BatchLedger:
    """A small table with a row when a batch is begun, and one for each day it touched when it has landed.

    One writer at a time. Rows are only added, and equal rows count once, so folding many small files into one may be
    cut off at any point. A reader that has listed the files before they are folded, once in ``FOLD_FILES`` entries, must
    read again.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._last: dict[str, tuple[int, str]] = {}

    def exists(self) -> bool:
        return read_table(self.spark, self.path) is not None

    def rows(self) -> DataFrame:
        table = read_table(self.spark, self.path)
        if table is None:
            return self.spark.createDataFrame([], SCHEMA)
        return table.distinct()

    def state(self, stream: str, batch_id: int) -> str | None:
        """``landed``, ``begun`` or None. Numbers rise within a run, so the table is read for its first batch only."""
        if stream not in self._last:
            found = self.rows().filter(F.col("stream") == stream).agg(F.max_by("state", F.struct("batch_id", "state")), F.max("batch_id")).first()
            self._last[stream] = (-1, LANDED) if found[1] is None else (found[1], found[0])
        last, state = self._last[stream]
        return LANDED if batch_id < last else state if batch_id == last else None

    def _add(self, stream: str, batch_id: int, state: str, days: dict[str | None, int]) -> None:
        entries = [(stream, batch_id, state, day, n) for day, n in (days or {None: 0}).items()]
        rows = from_rows(self.spark, entries, SCHEMA.rpartition(",")[0]).withColumn("at", F.current_timestamp())
        rows.coalesce(1).write.mode("append").parquet(self.path)
        self._last[stream] = (batch_id, state)
        self._fold()

    def _fold(self) -> None:
        table = self.spark.read.schema(SCHEMA).parquet(self.path)
        files = table.inputFiles()
        if len(files) < FOLD_FILES:
            return
        table.distinct().coalesce(1).write.mode("append").parquet(self.path)
        place = self.spark._jvm.org.apache.hadoop.fs.Path
        for file in files:
            old = place(file)
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, False)

    def once(self, stream: str, batch_id: int, work: Callable[[bool], dict[str | None, int]]) -> None:
        """Runs ``work(replay)`` unless the batch has landed, and notes the rows by day that it returns."""
        state = self.state(stream, batch_id)
        if state == LANDED:
            return
        if state is None:
            self._add(stream, batch_id, BEGUN, {})
        self._add(stream, batch_id, LANDED, work(state == BEGUN))

    def days_since(self, at: str | None) -> list[str | None]:
        """Days touched by batches that landed after ``at``, null for readings without a day; all of them for None."""
        landed = self.rows().filter((F.col("state") == LANDED) & (F.col("n") > 0))
        if at is not None:
            landed = landed.filter(F.col("at") > F.lit(at).cast("timestamp"))
        return partition_values(landed, "day")

    def batches_after(self, position: int, upto: int | None = None) -> tuple[int, list[str], list[str | None]]:
        """(position after them, markers, days) of the batches that landed after the first ``position`` ones.

        Batches are counted in the order in which they landed; a consumer keeps the position as its progress, and
        names the position ``upto`` which it had set out for when it repeats a failed run.
        """
        landed = self.rows().filter(F.col("state") == LANDED)
        each = landed.groupBy("stream", "batch_id").agg(
            F.min("at").alias("at"), F.array_sort(F.collect_set(F.when(F.col("n") > 0, F.coalesce("day", F.lit(""))))).alias("days"))
        # a row for each batch, with the days it touched
        later = each.orderBy("at", "stream", "batch_id").offset(position)
        found = (later if upto is None else later.limit(upto - position)).collect()
        days = {d or None for r in found for d in r["days"]}
        return position + len(found), [f"{r['stream']}-{r['batch_id']}" for r in found], list(days)


def land(rows: DataFrame, out: str, marker: str, replay: bool, partition: str = "date") -> dict[str | None, int]:
    """Adds a batch's rows to the table, with ``marker`` in its ``batch`` column; returns their number by partition value.

    A replay replaces what a failed attempt may have left: the touched partitions are written again without the rows of
    this batch, from a staged copy.
    """
    spark = rows.sparkSession
    marked = rows.withColumn(BATCH, F.lit(marker))
    counts = {r[0]: r[1] for r in rows.groupBy(partition).agg(F.count(F.lit(1))).collect()}
    existing = read_table(spark, out) if replay else None
    if existing is None:
        if counts:
            write_partitioned(marked, out, partition)
        return counts
    staged = scratch_path(spark, "replay")
    kept = in_partitions(existing, partition, list(counts)).filter(F.col(BATCH) != marker)
    overwrite(kept.unionByName(marked, allowMissingColumns=True), staged)
    replace_partitions(spark.read.parquet(staged), out, partition)
    remove_scratch(spark, staged)
    return counts
