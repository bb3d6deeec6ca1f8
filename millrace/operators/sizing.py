"""Size checks: which series must be split, and where."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace import config
from millrace.operators.indexing import number_rows
from millrace.session import shared_dir

SEGMENT = "_segment"
_SAMPLES_PER_SEGMENT = 32
_FAN = 64  # edges a row is joined with at a time
_SENT_EDGES = 200_000  # so many edges of all keys are small enough to go to every task
CUT = "_cut"  # whether the row's series has edges


def segment_edges(
    df: DataFrame, key: str, order: Sequence[str], max_rows: int = config.HOT_ROWS
) -> DataFrame | None:
    """Split points ``(key, edges)`` for every key with more than ``max_rows`` rows.

    None when there is no such key, which is the usual case and costs one aggregation over the
    key column. Otherwise each hot key gets the quantiles of a hash sample of its order tuples,
    at most about 32 per segment, so the list is bounded by the row count over ``max_rows``.
    The sample is a function of the values, thus the same on every recomputation; a tuple with
    many copies is one sample. The null key is a key like any other.
    """
    shared_dir(df.sparkSession)
    hot = (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > max_rows)
        .select(key, "_n", F.ceil(F.col("_n") / max_rows).cast("int").alias("_k"))
        .withColumn("_step", F.greatest(F.lit(1), F.expr(f"_n div (_k * {_SAMPLES_PER_SEGMENT})")))
        .checkpoint()
    )
    n_hot = hot.count()
    if not n_hot:
        return None
    position = F.struct(*[F.col(c) for c in order])
    rows = df.select(key, *order)
    hot = hot.withColumnRenamed(key, "_hot")
    hot = F.broadcast(hot) if n_hot <= _SENT_EDGES else hot
    sampled = (
        rows.join(hot, rows[key].eqNullSafe(hot["_hot"]))
        .filter(F.pmod(F.xxhash64(key, *order), F.col("_step")) == 0)
        .select(key, "_k", position.alias("_at"))
        .distinct()
    )
    # the sample is numbered over all tasks, as a key's part of it may be too long for one list
    numbered = number_rows(sampled.withColumnRenamed(key, "_hot"), ["_hot", "_at"], "_row")
    ranges = numbered.groupBy(F.col("_hot").alias(key)).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"), F.max("_k").cast("long").alias("_parts"))
    placed = numbered.join(ranges, F.col("_hot").eqNullSafe(F.col(key))).withColumn("_p", F.col("_row") - F.col("_first"))
    # the p-th tuple is an edge if i * size div parts is p for an i from 1 to parts - 1; the least one that reaches p is tried
    least = F.greatest(F.lit(1).cast("long"), F.expr("(_p * _parts + _size - 1) div _size"))
    chosen = placed.filter((least < F.col("_parts")) & (least * F.col("_size") < (F.col("_p") + 1) * F.col("_parts")))
    return chosen.groupBy(key).agg(F.sort_array(F.collect_list("_at")).alias("_edges")).checkpoint()


def with_segment(df: DataFrame, key: str, order: Sequence[str], edges: DataFrame | None) -> DataFrame:
    """Adds ``_segment``, how many edges of the row's key lie at or below its order tuple, and ``_cut``,
    whether the key has edges at all.

    Segments of a key follow each other in the order, and rows with equal tuples share one.
    """
    if edges is None:
        return df.withColumns({SEGMENT: F.lit(0), CUT: F.lit(False)})
    at = F.struct(*[F.col(c) for c in order])
    longest, total = edges.agg(F.max(F.size("_edges")), F.sum(F.size("_edges").cast("long"))).first()
    longest, total = longest or 1, total or 0
    # every edge in steps of _FAN ** n first, then those between the two steps found, so that no row carries all of a key's edges
    width = 1
    while width * _FAN <= longest:
        width *= _FAN
    placed = df.withColumns({SEGMENT: F.lit(0), CUT: F.lit(False)})
    while width:
        lists = _lists(edges, key, width, longest)
        lists = F.broadcast(lists) if total <= _SENT_EDGES else lists
        joined = placed.join(lists, placed[key].eqNullSafe(lists["_key"]) & (placed[SEGMENT] == lists["_base"]), "left")
        # the list's eighths first; the two steps are columns, as one expression would repeat the first
        joined = joined.withColumn("_eighth", _reached(at, F.lit(0), _FAN // 8))
        cut = F.col("_key_known").isNotNull()
        found = F.col("_eighth") + _reached(at, F.col("_eighth"), 1)
        placed = joined.withColumns({SEGMENT: F.when(cut, F.col(SEGMENT) + found * width).otherwise(F.col(SEGMENT)), CUT: F.col(CUT) | cut})
        placed = placed.drop("_key", "_base", "_list", "_key_known", "_eighth")
        width //= _FAN
    return placed


def _reached(at: Column, start: Column, step: int, low: int = 0, high: int = 8) -> Column:
    """The greatest of 0, ``step``, ... 7 ``step`` whose entry of ``_list``, counted from ``start``, lies at or below ``at``.

    A tree of three comparisons a row: unlike a loop over an array it becomes generated code.
    """
    if high - low == 1:
        return F.lit(low * step)
    middle = (low + high) // 2
    above = F.get(F.col("_list"), start + F.lit(middle * step - 1)) <= at
    return F.when(above, _reached(at, start, step, middle, high)).otherwise(_reached(at, start, step, low, middle))


def _lists(edges: DataFrame, key: str, width: int, longest: int) -> DataFrame:
    """(_key, _base, _list): after the first ``_base`` edges of a key, each ``width``-th of the next ``width * _FAN - 1``."""
    bases = edges.withColumn("_base", F.explode(F.sequence(F.lit(0), F.size("_edges"), F.lit(width * _FAN)))) if width * _FAN <= longest else (
        edges.withColumn("_base", F.lit(0)))
    ends = F.slice("_edges", F.col("_base") + 1, F.lit(width * _FAN - 1))
    return bases.select(F.col(key).alias("_key"), "_base", F.lit(True).alias("_key_known"), F.filter(ends, lambda _, i: (i + 1) % width == 0).alias("_list"))
