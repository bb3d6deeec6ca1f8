"""Per-unit reference values and filling gaps from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators.reshape import columns_with_prefix

REF = "ref_"


def compute_baselines(train: DataFrame, metrics: Sequence[str], unit: str = "unit_number") -> DataFrame:
    """Mean of every metric per unit as ``ref_<metric>``: one row per unit, so joins cannot fan out."""
    means = train.groupBy(unit).agg(*[F.avg(m).alias(REF + m) for m in metrics])
    return means.select(C.sensor_id_of(unit).alias("sensor_id"), *[REF + m for m in metrics])


def join_baselines(df: DataFrame, baselines: DataFrame) -> DataFrame:
    """Left join on the sensor. Baselines grow with the fleet, so adaptive execution picks the join by bytes."""
    return df.join(baselines, "sensor_id", "left")


def impute(silver: DataFrame, baselines: DataFrame | None, metrics: Sequence[str]) -> DataFrame:
    """Missing metric values become the unit's reference value.

    Columns without a reference are left alone; ``None`` (no baselines yet) leaves all alone.
    """
    if baselines is None:
        return silver
    known = set(columns_with_prefix(baselines, REF))
    filled = [
        F.coalesce(c, REF + c).alias(c) if c in metrics and REF + c in known else F.col(c)
        for c in silver.columns
    ]
    return join_baselines(silver, baselines).select(*filled)
