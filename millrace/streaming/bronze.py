"""Raw JSON files to the Bronze table, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.operators import cleaning
from millrace.session import remove_scratch, scratch_path
from millrace.sinks.tables import overwrite
from millrace.sources.files import CORRUPT, READING_SCHEMA, parse_payloads
from millrace.streaming.ledger import BatchLedger, land, ledger_of

MINUTE = "1 minute"
QUARANTINE_BATCHES = 1000  # batches of a quarantine folder


def stream_readings(
    spark: SparkSession,
    path: str,
    schema: T.StructType = READING_SCHEMA,
    max_files: int = 100,
    archive: str | None = None,
) -> DataFrame:
    """JSON-lines files as they land, at most ``max_files`` per micro-batch.

    With ``archive`` a file is moved there once its batch is committed, so landed files do not
    pile up and none is removed unread. A line that is no JSON has its text in ``CORRUPT`` and nothing else.
    """
    schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.readStream.schema(schema).option("columnNameOfCorruptRecord", CORRUPT).option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(path)


def stream_payloads(spark: SparkSession, path: str, max_files: int = 100) -> tuple[DataFrame, DataFrame]:
    """The same files as (readings, quarantined lines)."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).text(path)
    return parse_payloads(lines)


def to_bronze(readings: DataFrame) -> DataFrame:
    """Valid readings with processing time and day."""
    return cleaning.dated(cleaning.stamped(cleaning.valid_readings(readings).drop(CORRUPT)))


def start_bronze(
    stream: DataFrame, out: str, checkpoint: str, tag: str = "main", trigger: dict | None = None,
    quarantine: str | None = None, ledger: str | None = None,
) -> StreamingQuery:
    """Appends micro-batches to ``out``, partitioned by day, and notes each in a ledger beside it.

    The ledger (``<out>-ledger`` unless named) says which batches have landed and which days they touched. A batch that is
    replayed after a failure is recognised there: one that has landed is left out, one that was only begun replaces
    what it has written. Each reading lands once, and there is a folder for each day, not for each batch. Use a new
    ``tag`` with a new checkpoint: batch numbers start again there. Readings without a readable time go to the null-day partition.

    ``stream`` is what ``stream_readings`` or ``newest_in_stream`` gives. Lines that are no JSON and readings without a
    sensor go to ``quarantine``, in the same way; without that folder they are left out.
    """
    book = BatchLedger(stream.sparkSession, ledger or ledger_of(out))

    def write(batch: DataFrame, batch_id: int) -> None:
        book.once(tag, batch_id, lambda replay: _land_batch(batch, f"{tag}-{batch_id}", f"{tag}-{batch_id // QUARANTINE_BATCHES}", out, quarantine, replay))

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": MINUTE}))
        .start()
    )


def _land_batch(batch: DataFrame, marker: str, block: str, out: str, quarantine: str | None, replay: bool) -> dict[str | None, int]:
    """Rows that landed, by day. Both writes and the count read the batch, so it is computed once, into a staged copy."""
    spark = batch.sparkSession
    staged = scratch_path(spark, "batch")
    try:
        overwrite(batch, staged)
        batch = spark.read.schema(batch.schema).parquet(staged)
        if quarantine is not None:
            rejects = cleaning.stamped(batch.filter("sensor_id IS NULL OR sensor_id = ''"))
            land(rejects.withColumn("batches", F.lit(block)), quarantine, marker, replay, "batches")
        return land(to_bronze(batch), out, marker, replay)
    finally:
        remove_scratch(spark, staged)


def newest_in_stream(readings: DataFrame, lateness: str = "10 minutes", newest: str = "processed_at") -> DataFrame:
    """One reading per key, as a stream: the one that ``dedupe_readings`` keeps in a batch.

    The newest version of a reading is held as the state of an aggregation until the watermark passes the reading's
    time; then it is emitted once and its state goes. Versions may arrive in any order within ``lateness``; one that
    arrives later is dropped. Versions are ranked by ``newest``, which is the time of arrival if the readings have no such
    column. Lines without a sensor only move the watermark, so a heartbeat drains the state of a quiet stream;
    readings without a readable time are left to the quarantine.
    """
    if newest not in readings.columns:
        readings = cleaning.stamped(readings, newest)
    timed = cleaning.timed(readings.drop(CORRUPT)).withWatermark("event_timestamp", lateness)
    # tied to the time, so that the filter stays above the watermark
    usable = timed.filter(F.when(F.col("sensor_id") != "", F.col("event_timestamp")).isNotNull())
    return cleaning.dedupe_readings(usable, (*cleaning.READING_KEY, "event_timestamp"), newest).drop("event_timestamp")


def stream_window_avg(readings: DataFrame, window: str = MINUTE, lateness: str = "10 minutes") -> DataFrame:
    """Window means as a stream: duplicates within the lateness are dropped, and a window is
    emitted once the watermark has passed it."""
    timed = cleaning.timed(cleaning.valid_readings(readings)).withWatermark("event_timestamp", lateness)
    unique = timed.dropDuplicatesWithinWatermark(list(cleaning.READING_KEY))
    return unique.groupBy(
        "sensor_id", "engine_model", "time_in_cycles", "metric",
        F.window("event_timestamp", window).alias("time_window"),
    ).agg(F.avg("value").alias("value"))


def stream_features(readings: DataFrame, metrics: list[str], window: str = MINUTE,
                    lateness: str = "10 minutes") -> DataFrame:
    """Wide Silver rows as a stream: one column per metric."""
    timed = cleaning.timed(cleaning.valid_readings(readings)).withWatermark("event_timestamp", lateness)
    unique = timed.dropDuplicatesWithinWatermark(list(cleaning.READING_KEY))
    return unique.groupBy(
        "sensor_id", "engine_model", "time_in_cycles", F.window("event_timestamp", window).alias("time_window")
    ).agg(*[F.avg(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics])
