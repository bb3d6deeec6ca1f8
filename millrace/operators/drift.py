"""Two-sample Kolmogorov-Smirnov drift test, all features in one distributed pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace import config
from millrace.functions import columns as C
from millrace.operators.reshape import unpivot_readings
from millrace.operators.sizing import CUT, SEGMENT, segment_edges, with_segment
from millrace.session import scratch_path


def value_counts(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(``by``, feature, value, n): how often each distinct value occurs, without nulls and NaN.

    Counts of disjoint rows add up, so they can be stored per day and merged for any range of days.
    """
    return _values(df, features, by).groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def _values(df: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    known = [f for f in features if f in df.columns]
    return unpivot_readings(df, list(by), known).filter(~F.isnan("value")).withColumnRenamed("metric", "feature")


def ks_two_sample(
    reference: DataFrame, current: DataFrame, features: Sequence[str], hot_rows: int = config.HOT_ROWS
) -> DataFrame:
    """Per feature: ``n_ref``, ``n_cur``, statistic ``d`` and asymptotic ``p_value``.

    Null and NaN values are left out, and so is a feature without values on one side.
    """
    # every value counts as one, so both sides are counted by one aggregation
    one = F.lit(1).cast("long").alias("n")
    sides = (_values(side, features).select("feature", "value", one) for side in (reference, current))
    return ks_of_counts(*sides, hot_rows)


def ks_of_counts(reference: DataFrame, current: DataFrame, hot_rows: int = config.HOT_ROWS) -> DataFrame:
    """The same from the sides' ``value_counts``, which may have several rows for a value.

    A value that fills most rows is one row here. Counts are merged once and written; sizes and split points are read
    from that. The two distribution functions are running sums over the sorted values; when a feature has more than
    ``hot_rows`` distinct values, it is sorted in consecutive ranges, each starting from the totals of the ranges before.
    """
    spark = reference.sparkSession
    none = F.lit(0).cast("long")
    sides = reference.select("feature", "value", F.col("n").alias("c_ref"), none.alias("c_cur")).unionByName(
        current.select("feature", "value", none.alias("c_ref"), F.col("n").alias("c_cur")))
    merged = sides.groupBy("feature", "value").agg(F.sum("c_ref").alias("c_ref"), F.sum("c_cur").alias("c_cur"))
    # files by column take a tenth of a checkpoint's rows
    path = scratch_path(spark, "value-counts")
    merged.write.parquet(path)
    counts = spark.read.schema(merged.schema).parquet(path)
    sizes = counts.groupBy("feature").agg(F.sum("c_ref").alias("n_ref"), F.sum("c_cur").alias("n_cur")).filter("n_ref > 0 AND n_cur > 0")
    edges = segment_edges(counts, "feature", ["value"], hot_rows)
    below = _below(counts, ["feature"], "value") if edges is None else _below_by_segment(
        with_segment(counts, "feature", ["value"], edges).drop(CUT)
    )
    gap = F.abs(F.col("below_ref") / F.col("n_ref") - F.col("below_cur") / F.col("n_cur"))
    return (
        below.join(F.broadcast(sizes), "feature")  # one row per configured feature
        .groupBy("feature", "n_ref", "n_cur")
        .agg(F.max(gap).alias("d"))
        .withColumn("p_value", C.ks_p_value("d", "n_ref", "n_cur"))
    )


def _below(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How many values of each side lie at or below each distinct value."""
    up_to = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    return counts.select(
        *keys, F.sum("c_ref").over(up_to).alias("below_ref"), F.sum("c_cur").over(up_to).alias("below_cur")
    )


def _below_by_segment(placed: DataFrame) -> DataFrame:
    """The same with each segment sorted on its own and raised by the segments before it."""
    sums = placed.groupBy("feature", SEGMENT).agg(F.sum("c_ref").alias("s_ref"), F.sum("c_cur").alias("s_cur"))
    # one row per segment
    before = Window.partitionBy("feature").orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "feature", SEGMENT,
        F.coalesce(F.sum("s_ref").over(before), F.lit(0)).alias("o_ref"),
        F.coalesce(F.sum("s_cur").over(before), F.lit(0)).alias("o_cur"),
    )
    within = _below(placed, ["feature", SEGMENT], "value")
    return within.join(offsets, ["feature", SEGMENT]).select(
        "feature",
        (F.col("below_ref") + F.col("o_ref")).alias("below_ref"),
        (F.col("below_cur") + F.col("o_cur")).alias("below_cur"),
    )


def drift_flags(tests: DataFrame, p_value: float = config.DRIFT_P_VALUE) -> DataFrame:
    return tests.withColumn("drifted", F.col("p_value") < p_value)


def drift_summary(flags: DataFrame, n_features: int, share: float = config.DRIFT_SHARE) -> DataFrame:
    """One row. The share counts all configured features, also those that could not be tested."""
    counted = flags.agg(
        F.count_if("drifted").alias("number_of_drifted_columns"),
        F.count(F.lit(1)).alias("n_tested"),
    )
    ratio = (
        F.col("number_of_drifted_columns") / F.lit(float(n_features)) if n_features else F.lit(0.0)
    )
    return counted.withColumn("share_of_drifted_columns", ratio).withColumn(
        "dataset_drift", F.col("share_of_drifted_columns") >= share
    )


def drift_report(
    reference: DataFrame, current: DataFrame, features: Sequence[str], hot_rows: int = config.HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(the one fact row of this run, the flagged tests per feature)."""
    return drift_report_of_counts(value_counts(reference, features), value_counts(current, features), len(features), hot_rows)


def drift_report_of_counts(
    reference: DataFrame, current: DataFrame, n_features: int, hot_rows: int = config.HOT_ROWS
) -> tuple[DataFrame, DataFrame]:
    """The same from the sides' value counts."""
    flags = drift_flags(ks_of_counts(reference, current, hot_rows))
    fact = drift_summary(flags, n_features).select(
        C.date_key(F.current_timestamp()).alias("date_id"),
        "dataset_drift", "share_of_drifted_columns", "number_of_drifted_columns", "n_tested",
    )
    return fact, flags
