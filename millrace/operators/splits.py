"""An exact share of the rows, chosen by hash, without a sort."""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASH_BITS = 60
STEP_BITS = 15  # a histogram of 2**15 counts, of which each round narrows one


def key_hash(seed: int, *keys: Column | str) -> Column:
    """60 bits of the keys alone, the same in every run and on every partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def smallest(df: DataFrame, column: str, k: int, bits: int = HASH_BITS) -> tuple[int, int]:
    """(value, rest): the ``k``-th smallest of a column of ``bits``-bit numbers, and how many rows of that value are among
    the ``k`` smallest.

    Each round counts the rows of the bin found so far by their next ``STEP_BITS`` bits, at most 2**15 counts, and goes on
    in the bin that holds the ``k``-th. Rows are read once a round, four times at most, and never sorted or gathered.
    """
    prefix, left = 0, k
    for shift in range(bits - STEP_BITS, -1, -STEP_BITS):
        inside = df.filter(F.shiftrightunsigned(column, shift + STEP_BITS) == prefix) if shift + STEP_BITS < bits else df
        digit = F.shiftrightunsigned(column, shift).bitwiseAND(F.lit((1 << STEP_BITS) - 1)).alias("digit")
        for r in sorted(inside.groupBy(digit).agg(F.count(F.lit(1)).alias("n")).collect()):
            if r["n"] >= left:
                break
            left -= r["n"]
        prefix = prefix << STEP_BITS | r["digit"]
    return prefix, left


def with_exact_split(df: DataFrame, keys: Sequence[str], held_out: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``is_train``, false for exactly the share ``held_out`` of the rows, rounded up: those with the smallest hash of ``keys``.

    Which rows these are depends on the keys alone. Rows with the same keys that the share cuts through go by a hash of the whole
    row, then by their place, so the number is right with any copies; as places differ from plan to plan, pass a stored table
    where whole rows repeat. An empty table stays empty.
    """
    n = df.count()
    k = ceil(n * Fraction(str(held_out)))
    if not 0 < k < n:
        return df.withColumn("is_train", F.lit(k == 0 or n == 0))
    # places are partition and row number, below 60 bits
    hashed = df.withColumns({"_h": key_hash(seed, *keys), "_r": F.shiftrightunsigned(F.xxhash64(*df.columns), 4), "_p": F.monotonically_increasing_id()})
    held, among = F.lit(False), F.lit(True)
    rows, left = hashed, k
    for column in ("_h", "_r", "_p"):
        value, left = smallest(rows, column, left)
        held = held | (among & (F.col(column) < value))
        among = among & (F.col(column) == value)
        rows = rows.filter(F.col(column) == value)
        if column != "_p" and rows.count() == left:
            break  # all rows of the value
    return hashed.withColumn("is_train", ~(held | among)).drop("_h", "_r", "_p")
