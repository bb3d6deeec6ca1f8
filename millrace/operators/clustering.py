"""Clustering of files by several columns at once, so that a filter on any of them skips most row groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6  # a column's values are divided into 2**BITS ranges of about equally many rows
ACCURACY = 2000


def range_edges(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Split points of each numeric column: quantiles of all rows, from one aggregation that ends in one row."""
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(*[F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns]).first()
    return {c: sorted(set(found[c] or [])) for c in columns}


def range_number(column: str, edges: Sequence) -> Column:
    """How many edges lie below the value, by halving; 0 for null."""
    if not edges:
        return F.lit(0)
    known = F.array(*[F.lit(e) for e in edges])
    steps = F.array(*[F.lit(1 << b) for b in range(len(edges).bit_length() - 1, -1, -1)])
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(known, at + step - 1) < F.col(column), at + step).otherwise(at))
    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(below)


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """The numbers' bits in turn, from the highest: rows that are near in all columns are near in this one."""
    out = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for n in numbers:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(n.cast("long"), b).bitwiseAND(F.lit(1).cast("long")))
    return out


def clustered(df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), files: int | None = None, bits: int = BITS) -> DataFrame:
    """``df`` dealt and sorted by ``within`` and then by the interleaved ranges of ``columns``, ready to be written.

    The rows are read once more for the quantiles, of these columns only. Equal rows may be in several files, so a
    value that fills most rows does not make one large task.
    """
    edges = range_edges(df, columns, bits)
    place = interleaved([range_number(c, edges[c]) for c in columns], bits)
    spread = F.xxhash64(*df.columns)
    keyed = df.withColumns({"_place": place, "_spread": spread})
    order = [*within, "_place", "_spread"]
    dealt = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*within, "_place", *columns).drop("_place", "_spread")
