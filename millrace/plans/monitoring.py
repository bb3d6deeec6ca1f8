"""Drift run: Silver against the training sample."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import config
from millrace.ml.model import with_unit_number
from millrace.ml.runs import log_drift
from millrace.operators.drift import drift_report, drift_report_of_counts, value_counts
from millrace.session import remove_scratch, scratch_path
from millrace.sinks.tables import overwrite, replace_partitions
from millrace.sources.files import read_parquet, read_table

RUN = "run"


def drift_features(metrics: Sequence[str] = config.METRICS) -> list[str]:
    return ["unit_number", "time_in_cycles", *metrics]


def run_drift(spark: SparkSession, silver_path: str, reference_path: str, fact_path: str, runs_path: str,
              metrics: Sequence[str] = config.METRICS, dates: tuple[str, str] | None = None, run_id: str | None = None) -> bool:
    """Appends one drift fact and one run-log entry. False while there is no Silver row.

    A run that is retried with its ``run_id`` replaces its fact instead of adding another.
    """
    silver = read_table(spark, silver_path, dates)
    if silver is None or silver.isEmpty():
        return False
    features = drift_features(metrics)
    current = with_unit_number(silver).select(*features)
    fact, tests = drift_report(read_parquet(spark, reference_path), current, features)
    _keep(spark, fact, tests, fact_path, runs_path, run_id)
    return True


def _keep(spark: SparkSession, fact: DataFrame, tests: DataFrame, fact_path: str, runs_path: str, run_id: str | None) -> None:
    fact, tests = fact.checkpoint(), tests.checkpoint()
    # a partition for each run, so that writing it again replaces it
    replace_partitions(fact.coalesce(1).withColumn(RUN, F.lit(run_id or uuid.uuid4().hex)), fact_path, RUN)
    # one row, and one row per feature
    p_values = {r["feature"]: r["p_value"] for r in tests.select("feature", "p_value").collect()}
    log_drift(spark, runs_path, fact.first().asDict(), p_values)


def refresh_value_counts(spark: SparkSession, silver_path: str, counts_path: str, metrics: Sequence[str] = config.METRICS,
                         dates: tuple[str, str] | None = None) -> bool:
    """Stores how often every value of every feature occurs, per day, for the given days or all; False without Silver."""
    silver = read_table(spark, silver_path, dates)
    if silver is None:
        return False
    features = drift_features(metrics)
    counts = value_counts(with_unit_number(silver).select(*features, "date"), features, ["date"])
    staged = scratch_path(spark, "value-counts")
    overwrite(counts, staged)
    replace_partitions(spark.read.parquet(staged), counts_path)
    remove_scratch(spark, staged)
    return True


def store_reference_counts(spark: SparkSession, reference_path: str, counts_path: str, metrics: Sequence[str] = config.METRICS) -> None:
    """The reference side's counts, built once for a model."""
    overwrite(value_counts(read_parquet(spark, reference_path), drift_features(metrics)), counts_path)


def run_drift_from_counts(spark: SparkSession, counts_path: str, reference_counts_path: str, fact_path: str, runs_path: str,
                          metrics: Sequence[str] = config.METRICS, dates: tuple[str, str] | None = None,
                          run_id: str | None = None) -> bool:
    """``run_drift`` over any range of days from the stored counts; neither Silver nor the reference sample is read."""
    counts = read_table(spark, counts_path, dates)
    if counts is None or counts.isEmpty():
        return False
    fact, tests = drift_report_of_counts(read_parquet(spark, reference_counts_path), counts, len(drift_features(metrics)))
    _keep(spark, fact, tests, fact_path, runs_path, run_id)
    return True
