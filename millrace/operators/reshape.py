"""Between wide rows and long readings, and the averages over time windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import config
from millrace.functions import columns as C


def unpivot_readings(wide: DataFrame, ids: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """One row per metric of each wide row; values that are not numbers give no row."""
    if not metrics:
        return wide.select(*ids, F.lit("").alias("metric"), F.lit(0.0).alias("value")).limit(0)
    texts = {f.name for f in wide.schema if f.dataType.simpleString() == "string"}

    def number(m: str) -> Column:
        parsed = F.col(m).try_cast("double")
        # a failed parse costs an exception, so text that cannot be a number is not parsed
        return F.when(F.col(m).rlike("[0-9]|(?i)nan|inf"), parsed) if m in texts else parsed

    numbers = wide.select(*ids, *[number(m).alias(m) for m in metrics])
    return numbers.unpivot(list(ids), list(metrics), "metric", "value").filter("value IS NOT NULL")


def window_avg(
    readings: DataFrame,
    window: str = "1 minute",
    keys: Sequence[str] = ("sensor_id", "engine_model", "time_in_cycles", "metric"),
    time: str = "event_timestamp",
) -> DataFrame:
    """Mean value per key and tumbling window; partial averages are formed before the shuffle."""
    return (
        readings.groupBy(*keys, F.window(time, window).alias("time_window"))
        .agg(F.avg("value").alias("value"))
    )


def pivot_metrics(
    readings: DataFrame,
    metrics: Sequence[str] = config.METRICS,
    window: str = "1 minute",
    keys: Sequence[str] = ("sensor_id", "engine_model", "time_in_cycles"),
    time: str = "event_timestamp",
) -> DataFrame:
    """Window means as one column per metric; a metric without readings gives a null column.

    One aggregation over the keys does both the averaging and the pivot: its partial rows hold
    all metrics of a window, and the messages of a window arrive together, so one row per window
    and task crosses the network instead of one per metric.
    """
    return readings.groupBy(*keys, F.window(time, window).alias("time_window")).agg(
        *[F.avg(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in metrics]
    )


def with_window_keys(windowed: DataFrame, column: str = "time_window") -> DataFrame:
    """Replaces the window struct by its start as text and the day of it."""
    start = F.col(f"{column}.start")
    return windowed.select(
        *[c for c in windowed.columns if c != column],
        start.cast("string").alias("window_start"),
        start.cast("date").cast("string").alias("date"),
    )


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def drop_prefix(df: DataFrame, prefix: str = "ref_") -> DataFrame:
    return df.drop(*columns_with_prefix(df, prefix))


def assign_engine_model(df: DataFrame, unit: str = "unit_number",
                        models: Sequence[str] = config.ENGINE_MODELS) -> DataFrame:
    """Sets ``engine_model`` from the unit number, replacing any value there."""
    return df.withColumn("engine_model", C.engine_model_of(unit, models))
