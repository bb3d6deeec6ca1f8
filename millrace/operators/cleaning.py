"""From raw readings to valid, dated, unique ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import columns as C

READING_KEY = ("sensor_id", "metric", "event_time")


def valid_readings(readings: DataFrame) -> DataFrame:
    """Readings that name their sensor."""
    return readings.filter("sensor_id IS NOT NULL AND sensor_id <> ''")


def rejected_readings(readings: DataFrame) -> DataFrame:
    """The readings that the flows leave out, with ``reason``: no sensor, or no readable time."""
    no_sensor = F.col("sensor_id").isNull() | (F.col("sensor_id") == "")
    no_time = C.event_timestamp("event_time").isNull()
    reason = F.when(no_sensor, "no sensor").when(no_time, "no readable time")
    return readings.withColumn("reason", reason).filter("reason IS NOT NULL")


def stamped(df: DataFrame, column: str = "processed_at") -> DataFrame:
    """Adds the processing time."""
    return df.withColumn(column, F.current_timestamp())


def dated(readings: DataFrame) -> DataFrame:
    """Adds the day of ``event_time`` as ``date``."""
    return readings.withColumn("date", C.event_date("event_time"))


def timed(readings: DataFrame) -> DataFrame:
    """Adds ``event_timestamp``; readings with an unreadable time carry a null there."""
    return readings.withColumn("event_timestamp", C.event_timestamp("event_time"))


def split_by_time(readings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readings with a readable time, the others), so that nothing is lost silently."""
    with_time = timed(readings)
    return (
        with_time.filter(F.col("event_timestamp").isNotNull()),
        with_time.filter(F.col("event_timestamp").isNull()).drop("event_timestamp"),
    )


def with_default_model(readings: DataFrame) -> DataFrame:
    """Readings of producers that send no engine model get the default one."""
    return readings.withColumn("engine_model", C.or_default_model("engine_model"))


def newest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the one with the highest ``order`` values, nulls lowest.

    The filter on the row number lets Spark keep one row per key in each task before the shuffle
    (WindowGroupLimit), so a key with any number of copies sends one row per task. A hash of the
    whole row settles ties, which makes the survivor the same in every run.
    """
    newest_first = [F.col(c).desc() for c in order] + [F.xxhash64(*df.columns).desc()]
    ranking = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")


def dedupe_readings(readings: DataFrame, key: Sequence[str] = READING_KEY, newest: str = "processed_at") -> DataFrame:
    """One reading per ``key``, so that replays cannot bias the window averages: the one with the latest
    ``newest`` (if the readings carry it), of equal ones that with the larger value, then the larger other columns.

    Copies meet in an aggregation that combines within each task before the shuffle.
    """
    rest = [c for c in readings.columns if c not in key]
    first = [c for c in (newest, "value") if c in rest]
    rank = F.struct(*first, *[c for c in rest if c not in first])
    best = readings.groupBy(*key).agg(F.max(rank).alias("_best"))
    return best.select(*[F.col(c) if c in key else F.col(f"_best.{c}").alias(c) for c in readings.columns])


def last_row(df: DataFrame, unit: str, order: Sequence[str]) -> DataFrame:
    """The whole last row of each unit, e.g. its last cycle."""
    return newest_per_key(df, [unit], order)


def last_values(df: DataFrame, unit: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last non-null value of each column per unit, which may stem from different rows.

    ``max_by`` combines within each task before the shuffle, so a long series costs no more than
    a short one.
    """
    at = F.struct(*[F.col(c) for c in order])
    return df.groupBy(unit).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in columns]
    )
