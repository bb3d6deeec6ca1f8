"""The maintenance dashboard's queries over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.cleaning import last_row


def star_join(fact: DataFrame, engines: DataFrame, dates: DataFrame, statuses: DataFrame) -> DataFrame:
    """Facts with their dimension attributes. ``dim_status`` has three rows; a fact without a band (its prediction
    is missing) keeps its row with a null status."""
    return (
        fact.join(engines, "engine_id")
        .join(dates, "date_id")
        .join(F.broadcast(statuses), "status_id", "left")
    )


def sliced(star: DataFrame, engines: Sequence[str] | None = None, first: str | None = None,
           last: str | None = None, statuses: Sequence[str] | None = None) -> DataFrame:
    """The slicers: engines, range of window starts (inclusive), status labels; None means all.

    Where the fact's ``date`` is among the columns, the range also goes there as days, so other days are not read.
    """
    if "date" in star.columns:
        if first is not None:
            star = star.filter(F.col("date") >= first[:10])
        if last is not None:
            star = star.filter(F.col("date") <= last[:10])
    if engines is not None:
        star = star.filter(F.col("sensor_id").isin(list(engines)))
    if first is not None:
        star = star.filter(F.col("timestamp_str") >= first)
    if last is not None:
        star = star.filter(F.col("timestamp_str") <= last)
    if statuses is not None:
        star = star.filter(F.col("status_label").isin(list(statuses)))
    return star


MAX_SLICED = 10_000


def sliced_fact(fact: DataFrame, engines: DataFrame, sensors: Sequence[str] | None = None, first: str | None = None,
                last: str | None = None) -> DataFrame:
    """Facts of the chosen engines and range of window starts, before any join.

    The slicers become literals on the fact's own columns: days prune partitions, keys prune row groups by their statistics,
    as ``run_gold`` clusters by both. The engines' keys are looked up in the dimension, as many as a user has chosen; more than
    ``MAX_SLICED`` are joined instead.
    """
    digits = lambda text: int("".join(c for c in text if c.isdigit())[:12].ljust(12, "0"))
    if first is not None:
        fact = fact.filter((F.col("date") >= first[:10]) & (F.col("date_id") >= digits(first)))
    if last is not None:
        fact = fact.filter((F.col("date") <= last[:10]) & (F.col("date_id") <= digits(last)))
    if sensors is None:
        return fact
    chosen = engines.filter(F.col("sensor_id").isin(list(sensors))).select("engine_id").distinct()
    keys = [r[0] for r in chosen.limit(MAX_SLICED + 1).collect()]
    return fact.filter(F.col("engine_id").isin(keys)) if len(keys) <= MAX_SLICED else fact.join(chosen, "engine_id", "left_semi")


def rul_over_time(star: DataFrame) -> DataFrame:
    """Trajectory of the prediction per engine, in time order."""
    return star.select("sensor_id", "timestamp_str", "time_in_cycles", "predicted_rul").orderBy(
        "sensor_id", "timestamp_str", "time_in_cycles"
    )


def current_state(star: DataFrame) -> DataFrame:
    """The latest fact of every engine."""
    return last_row(star, "sensor_id", ["timestamp_str", "time_in_cycles"])


def status_counts(star: DataFrame) -> DataFrame:
    """Engines per current health state."""
    return current_state(star).groupBy("status_id", "status_label").agg(F.count(F.lit(1)).alias("engines"))


def latest_sensors(star: DataFrame, sensors: Sequence[str]) -> DataFrame:
    return current_state(star).select("sensor_id", "timestamp_str", *sensors)


def metric_trend(star: DataFrame, columns: Sequence[str], bucket: str = "day") -> DataFrame:
    """Mean of the chosen columns per time bucket over the (sliced) fleet."""
    start = F.date_trunc(bucket, F.col("timestamp")).cast("string").alias("bucket")
    return star.groupBy(start).agg(*[F.avg(c).alias(c) for c in columns])


def rul_correlation(fact: DataFrame, sensors: Sequence[str], rul: str = "predicted_rul") -> DataFrame:
    """Per sensor: rows, correlation with the RUL and the line ``rul = slope * sensor + intercept``.

    All sensors come from one aggregation that ends in a single row; unpivoting happens after it. A constant sensor has
    no correlation and no line.
    """
    def spread(c: str, other: str) -> Column:
        return F.stddev_pop(F.when(F.col(other).isNotNull(), F.col(c)))

    stats = fact.agg(
        *[
            F.struct(
                F.count(F.when(F.col(rul).isNotNull(), F.col(s))).alias("n"),
                F.try_divide(F.covar_pop(rul, s), F.nullif(spread(rul, s) * spread(s, rul), F.lit(0.0))).alias("correlation"),
                F.regr_slope(rul, s).alias("slope"),
                F.regr_intercept(rul, s).alias("intercept"),
            ).alias(s)
            for s in sensors
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("sensor"),
                F.col(s)["n"].alias("n"),
                F.col(s)["correlation"].alias("correlation"),
                F.col(s)["slope"].alias("slope"),
                F.col(s)["intercept"].alias("intercept"),
            )
            for s in sensors
        ]
    )
    return stats.select(F.inline(rows))


def correlation_signs(correlations: DataFrame, expected: dict[str, int]) -> DataFrame:
    """For the sensors with an expected correlation sign: the sign found, and whether they agree.
    A constant sensor has no correlation and so no sign."""
    want = F.lit(None).cast("int")
    for sensor, sign in expected.items():
        want = F.when(F.col("sensor") == sensor, F.lit(sign)).otherwise(want)
    return (
        correlations.withColumn("expected_sign", want)
        .filter("expected_sign IS NOT NULL")
        .withColumn("found_sign", F.signum("correlation").try_cast("int"))
        .select("sensor", "found_sign", "expected_sign",
                (F.col("found_sign") == F.col("expected_sign")).alias("as_expected"))
    )


def family_signs(sensors: Sequence[str]) -> dict[str, int]:
    """Temperatures rise as life runs out, cooling flows fall."""
    signs = {s: -1 for s in sensors if s.startswith("temp_")}
    signs.update({s: 1 for s in sensors if s.startswith("debit_refroidissement")})
    return signs
