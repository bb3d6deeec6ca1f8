"""Bronze readings to the wide Silver table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import config
from millrace.operators import baselines as B
from millrace.operators import cleaning, reshape
from millrace.sinks.tables import in_partitions, overwrite, partition_values, upsert
from millrace.sources.files import READING_SCHEMA, read_table
from millrace.streaming.ledger import BatchLedger, ledger_of

SILVER_KEY = ("sensor_id", "window_start")
# equal processing times are settled by the later cycle, then by the model name
SILVER_ORDER = ("silver_processed_at", "time_in_cycles", "engine_model")


def silver_features(
    readings: DataFrame,
    baselines: DataFrame | None,
    metrics: Sequence[str] = config.METRICS,
    window: str = "1 minute",
) -> DataFrame:
    """Valid, unique readings as one row per unit, cycle and window with gaps filled."""
    unique = cleaning.dedupe_readings(cleaning.valid_readings(readings))
    with_time, _ = cleaning.split_by_time(unique)
    wide = reshape.pivot_metrics(with_time, metrics, window)
    return reshape.with_window_keys(B.impute(wide, baselines, metrics))


def run_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    baselines_path: str | None = None,
    metrics: Sequence[str] = config.METRICS,
    window: str = "1 minute",
    dates: tuple[str, str] | None = None,
    since: str | None = None,
    quarantine_path: str | None = None,
) -> bool:
    """Upserts Silver from Bronze: all of it, the given days, or the days touched by what was processed after
    ``since``. False while there is no Bronze.

    The days come from the ledger that ``start_bronze`` keeps, so Bronze is read in those days only; a Bronze table
    without a ledger is searched for them.

    Readings without a sensor or a readable time are no Silver rows; with ``quarantine_path`` those of this
    run are written there, with the reason, in place of the last run's.
    """
    bronze = read_table(spark, bronze_path, dates)
    if bronze is None:
        return False
    if since is not None:
        ledger = BatchLedger(spark, ledger_of(bronze_path))
        if ledger.exists():
            bronze = in_partitions(bronze, "date", ledger.days_since(since))
        else:
            bronze = touched_days(bronze.filter(F.col("processed_at") > F.lit(since).cast("timestamp")), bronze)
    baselines = read_table(spark, baselines_path) if baselines_path else None
    known = [c for c in (*READING_SCHEMA.names, "processed_at") if c in bronze.columns]
    if quarantine_path is not None:
        overwrite(cleaning.rejected_readings(bronze.select(*known)), quarantine_path)
    silver = silver_features(bronze.select(*known), baselines, metrics, window)
    upsert(cleaning.stamped(silver, "silver_processed_at"), silver_path, SILVER_KEY, SILVER_ORDER)
    return True


def touched_days(arrivals: DataFrame, history: DataFrame) -> DataFrame:
    """All readings of the days that ``arrivals`` has readings for, so that a late reading gets
    its whole window averaged again; arrivals without a day bring back all readings without one. Days are at
    most as many as the calendar has and go into the filter as literals, which prunes the ``date`` partitions."""
    return in_partitions(history, "date", partition_values(arrivals, "date"))
