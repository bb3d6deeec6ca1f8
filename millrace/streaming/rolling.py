"""Rolling features of a stream of feature rows, from the last rows of each series."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace import config
from millrace.operators.rolling import feature_names

STATE = "tail binary, held binary"
BUCKETS = 512
_AT, _TIE, _BUCKET = "_at", "_tie", "_bucket"
_CHUNK = 1 << 14  # rows whose frames are laid out at once


def frame_statistics(values: np.ndarray, width: int, last: int, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Means and sample deviations over up to ``width`` rows that end at each of the ``last`` rows; NaN stands for null.

    Where several series follow each other, ``place`` has each value's number in its series, from 0, and a frame stays in its series.
    """
    return _statistics(values, width, np.arange(len(values) - last, len(values)), place)


def _statistics(values: np.ndarray, width: int, at: np.ndarray, place: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The same for the rows ``at``."""
    padded = np.concatenate([np.full((width - 1, values.shape[1]), np.nan), values])
    windows = np.lib.stride_tricks.sliding_window_view(padded, width, axis=0)
    back = np.arange(width - 1, -1, -1)
    mean, deviation = np.empty((len(at), values.shape[1])), np.empty((len(at), values.shape[1]))
    for start in range(0, len(at), _CHUNK):
        rows = at[start:start + _CHUNK]
        frames = windows[rows]
        known = ~np.isnan(frames)
        if place is not None:
            known &= (back[None, :] <= place[rows][:, None])[:, None, :]
        count = known.sum(axis=2)
        with np.errstate(invalid="ignore", divide="ignore"):
            m = np.where(known, frames, 0.0).sum(axis=2) / count
            squares = np.where(known, (frames - m[:, :, None]) ** 2, 0.0).sum(axis=2)
            mean[start:start + _CHUNK], deviation[start:start + _CHUNK] = m, np.where(count > 1, np.sqrt(squares / (count - 1)), 0.0)
    return mean, deviation


def _packed(frame: pd.DataFrame) -> bytes:
    table, sink = pa.Table.from_pandas(frame, preserve_index=False), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes | None, columns: Sequence[str]) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas() if data else pd.DataFrame(columns=list(columns))


def _step(columns: Sequence[str], unit: str, order: Sequence[str], sensors: Sequence[str], windows: Sequence[int]) -> Callable:
    reach = max(windows) - 1

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tail, held = (_unpacked(x, columns) for x in (state.get if state.exists else (None, None)))
        arrived = [] if state.hasTimedOut else [frame[list(columns)] for frame in frames]
        held = pd.concat([x for x in (held, *arrived) if len(x)] or [held], ignore_index=True)
        passed = state.getCurrentWatermarkMs()
        ready = held[held[_AT] <= passed].sort_values([*order, _TIE], ignore_index=True)
        held = held[held[_AT] > passed]
        known = pd.concat([x for x in (tail, ready) if len(x)] or [tail], ignore_index=True)
        # the rows of a unit together, first its tail
        units = pd.factorize(known[unit])[0]
        by_unit = np.argsort(units, kind="stable")
        known, units, fresh = known.iloc[by_unit], units[by_unit], np.flatnonzero(by_unit >= len(tail))
        first = np.searchsorted(units, units, side="left")
        left = np.searchsorted(units, units, side="right") - np.arange(len(units))
        if len(held):
            state.setTimeoutTimestamp(int(held[_AT].min()))
        state.update((_packed(known[left <= reach]), _packed(held)))
        if len(ready):
            values = known[list(sensors)].to_numpy(dtype=np.float64, na_value=np.nan)
            place, features = np.arange(len(units)) - first, {}
            for w in windows:
                means, deviations = _statistics(values, w, fresh, place)
                features |= {f"{s}_mean_{w}": means[:, i] for i, s in enumerate(sensors)}
                features |= {f"{s}_std_{w}": deviations[:, i] for i, s in enumerate(sensors)}
            names = [c for c in columns if c not in (_AT, _TIE)]
            done = known.iloc[fresh][names].reset_index(drop=True)
            yield pd.concat([done, pd.DataFrame(features)[feature_names(sensors, windows)]], axis=1)

    return run


def rolling_in_stream(rows: DataFrame, unit: str, order: Sequence[str], sensors: Sequence[str], time: str,
                      lateness: str = "10 minutes", windows: Sequence[int] = config.ROLLING_WINDOWS, buckets: int = BUCKETS) -> DataFrame:
    """The columns that ``rolling_features`` appends in a batch, for a stream of feature rows.

    The state of a unit is its last ``max(windows) - 1`` rows, and those that wait: a row is worked on once the watermark on
    ``time`` has passed it, so rows may arrive in any order within ``lateness``; later ones are dropped. ``order`` must agree
    with ``time``. Rows without a unit only move the watermark. A NaN counts as a missing value here.

    Units are dealt by hash to ``buckets`` states, each worked on with one call a micro-batch, however many units it has. A bucket's
    rows of one micro-batch and its state are held in one task: the source's rate limit bounds the first, ``buckets`` both. A started
    stream keeps its number of buckets.
    """
    stamped = rows.withColumns({_AT: F.unix_millis(F.col(time)), _TIE: F.xxhash64(*rows.columns)}).withWatermark(time, lateness)
    usable = stamped.filter(F.when(F.col(unit).isNotNull(), F.col(time)).isNotNull())
    out = T.StructType([*rows.schema.fields, *[T.StructField(c, T.DoubleType()) for c in feature_names(sensors, windows)]])
    step = _step(usable.columns, unit, order, sensors, windows)
    dealt = usable.withColumn(_BUCKET, F.pmod(F.xxhash64(unit), F.lit(buckets)).cast("int"))
    return dealt.groupBy(_BUCKET).applyInPandasWithState(step, out, STATE, "append", GroupStateTimeout.EventTimeTimeout)
