"""Row positions without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import shared_dir

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row within its partition in these bits


def number_in_place(df: DataFrame, column: str = "row_index") -> DataFrame:
    """Numbers the rows 0, 1, 2, ... in partition order.

    Ids are made per partition and the numbering adds the sizes of the partitions before. They
    depend on the partitioning, so they are checkpointed before they are used twice.
    """
    shared_dir(df.sparkSession)
    local = df.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", _LOCAL_BITS)
    # one row per partition of the input
    sizes = local.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    in_part = F.col("_id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    return (
        local.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn(column, in_part + F.col("_before"))
        .drop("_part", "_id", "_before")
    )


def number_rows(df: DataFrame, order: Sequence[str], column: str = "row_index") -> DataFrame:
    """Position of each row in ``order``, from 0. The sort is range-partitioned over all tasks."""
    return number_in_place(df.orderBy(*order), column)


def join_by_position(units: DataFrame, truth: DataFrame, unit: str = "unit_number") -> DataFrame:
    """The i-th unit by number meets the truth value with ``row_index`` i; units beyond the truth have null."""
    return number_rows(units, [unit]).join(truth, "row_index", "left").drop("row_index")
