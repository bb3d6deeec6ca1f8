"""Remaining-useful-life labels, bands, coercion, splits and error measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace import config
from millrace.functions import columns as C


def with_rul(df: DataFrame, unit: str = "unit_number", cycle: str = "time_in_cycles") -> DataFrame:
    """Adds ``RUL``: cycles left until the unit's last recorded one. Rows without a unit are one unit."""
    last = df.groupBy(F.col(unit).alias("_unit")).agg(F.max(cycle).alias("_last"))
    joined = df.join(last, df[unit].eqNullSafe(last["_unit"]))
    return joined.withColumn("RUL", F.col("_last") - F.col(cycle)).drop("_last", "_unit")


def cap_rul(df: DataFrame, cap: float = config.RUL_CAP, column: str = "RUL") -> DataFrame:
    return df.withColumn(column, C.capped_rul(column, cap))


def with_health_band(df: DataFrame, rul: str = "predicted_rul") -> DataFrame:
    return df.withColumn("status_id", C.health_band(rul))


def whole_numbers(df: DataFrame, columns: Sequence[str] = config.INTEGER_COLUMNS) -> DataFrame:
    """Coerces the named columns the frame has; see ``functions.columns.whole_number``."""
    return df.withColumns({c: C.whole_number(c) for c in columns if c in df.columns})


def with_split(df: DataFrame, keys: Sequence[str], train_percent: int = 80, seed: int = 42) -> DataFrame:
    """Adds ``is_train``. The side depends on the keys alone, not on partitioning or order."""
    return df.withColumn("is_train", C.hash_percent(seed, *keys) < train_percent)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: number of rows, RMSE and MAE."""
    error = F.col(label) - F.col(prediction)
    return df.agg(
        F.count(error).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
    )


def preview(df: DataFrame, unit: str, predicted: str, actual: str, n: int = 10) -> DataFrame:
    """The first ``n`` units with the prediction rounded to one digit."""
    return (
        df.select(unit, F.round(predicted, 1).alias(predicted), actual).orderBy(unit).limit(n)
    )
