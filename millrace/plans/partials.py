"""Silver from stored partial averages, so that late readings cost their own windows and no day is averaged again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import config
from millrace.operators import baselines as B
from millrace.operators import cleaning, reshape
from millrace.plans.silver import SILVER_KEY, SILVER_ORDER
from millrace.session import remove_scratch, scratch_path
from millrace.sinks.tables import in_partitions, overwrite, partition_values, replace_partitions, upsert
from millrace.sources.files import READING_SCHEMA, read_table
from millrace.streaming.ledger import BATCH, BatchLedger, ledger_of

KEYS = ("sensor_id", "engine_model", "time_in_cycles")
WINDOW_KEYS = ("window_start", "date")
LOAD = "load"
CONSUMER = "silver"


def _parts(metrics: Sequence[str]) -> list[str]:
    return [f"{part}_{m}" for part in ("n", "sum") for m in metrics]


def partial_means(readings: DataFrame, metrics: Sequence[str] = config.METRICS, window: str = "1 minute") -> DataFrame:
    """Count and sum of every metric per unit, cycle and window: what averages can be merged from."""
    value = {m: F.when(F.col("metric") == m, F.col("value")) for m in metrics}
    timed = cleaning.split_by_time(cleaning.valid_readings(readings))[0]
    windows = timed.groupBy(*KEYS, F.window("event_timestamp", window).alias("time_window")).agg(
        *[F.count(v).alias(f"n_{m}") for m, v in value.items()], *[F.sum(v).alias(f"sum_{m}") for m, v in value.items()])
    return reshape.with_window_keys(windows)


def merged_partials(existing: DataFrame, arrivals: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Counts and sums of both, per window."""
    both = existing.select(*KEYS, *WINDOW_KEYS, *_parts(metrics)).unionByName(arrivals.select(*KEYS, *WINDOW_KEYS, *_parts(metrics)))
    return both.groupBy(*KEYS, *WINDOW_KEYS).agg(*[F.sum(p).alias(p) for p in _parts(metrics)])


def means_of(partials: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """The wide rows that ``pivot_metrics`` gives for all readings together."""
    means = [(F.col(f"sum_{m}") / F.nullif(F.col(f"n_{m}"), F.lit(0))).alias(m) for m in metrics]
    return partials.select(*KEYS, *means, *WINDOW_KEYS)


def apply_load(arrivals: DataFrame, path: str, load: int, metrics: Sequence[str] = config.METRICS) -> list[str | None]:
    """Merges the partial means of load number ``load`` into the table at ``path``; returns the days it touched.

    Reads the arrivals and the touched days' partials only. Numbers rise from load to load, and each day's rows carry
    the last number merged into them, so a load that is repeated after a failure is added to the days that lack it and left
    alone in the others.
    """
    spark = arrivals.sparkSession
    incoming, staged = scratch_path(spark, "arrivals"), scratch_path(spark, "partials")
    overwrite(arrivals, incoming)
    arrivals = spark.read.schema(arrivals.schema).parquet(incoming)
    days = partition_values(arrivals, "date")
    existing = read_table(spark, path)
    if existing is not None:
        current = in_partitions(existing, "date", days)
        done = partition_values(current.filter(F.col(LOAD) >= load), "date")
        todo = [d for d in days if d not in done]
        arrivals = merged_partials(in_partitions(existing, "date", todo), in_partitions(arrivals, "date", todo), metrics)
    overwrite(arrivals.withColumn(LOAD, F.lit(load).cast("long")), staged)
    replace_partitions(spark.read.parquet(staged), path)
    remove_scratch(spark, incoming, staged)
    return days


def run_silver_incrementally(
    spark: SparkSession, bronze_path: str, partials_path: str, silver_path: str, baselines_path: str | None = None,
    metrics: Sequence[str] = config.METRICS, window: str = "1 minute",
) -> bool:
    """Brings Silver up to date with the Bronze batches that landed since the last run. False if there were none.

    The ledgers say which batches those are, which days they touched, and how far this flow has come. Bronze is read in
    those days for the rows of those batches, partials and Silver in the days of their windows. A run that failed is
    repeated with the same batches. Copies of a reading must have been settled before, as ``newest_in_stream`` does:
    counts and sums cannot tell a copy from a reading.
    """
    progress = BatchLedger(spark, ledger_of(partials_path))
    position = progress.rows().filter(F.col("state") == "landed").agg(F.max("batch_id")).first()[0] or 0
    begun = progress.rows().filter((F.col("state") == "begun") & (F.col("batch_id") > position)).agg(F.min("batch_id")).first()[0]
    upto, markers, days = BatchLedger(spark, ledger_of(bronze_path)).batches_after(position, begun)
    if not markers:
        return False

    def work(replay: bool) -> dict[str | None, int]:
        bronze = read_table(spark, bronze_path)
        if bronze is None or not days:
            return {}
        fresh = in_partitions(bronze, "date", days).filter(F.col(BATCH).isin(markers)).select(*READING_SCHEMA.names)
        touched = apply_load(partial_means(fresh, metrics, window), partials_path, upto, metrics)
        partials = read_table(spark, partials_path)
        if partials is None:
            return {}
        baselines = read_table(spark, baselines_path) if baselines_path else None
        # windows of the touched days that this load has not changed are the same again, so the upsert leaves them as they are
        changed = means_of(in_partitions(partials, "date", touched), metrics)
        silver = B.impute(changed, baselines, metrics)
        upsert(cleaning.stamped(silver, "silver_processed_at"), silver_path, SILVER_KEY, SILVER_ORDER)
        return dict.fromkeys(touched, 1)

    progress.once(CONSUMER, upto, work)
    return True
