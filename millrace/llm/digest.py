"""Fingerprints of texts from their improbable features: rare byte windows in chained Bloom filters."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import opened, shipped, stored
from millrace.llm.words import mixed, sliding_min

WINDOW = 64  # bytes of a feature
RUN = 64  # consecutive windows among which the rarest one gets a vote
VOTES = 16  # votes that select a window
LEVELS = 1000  # steps of entropy, from one repeated byte to all bytes different
WEAK_LEVEL = 100  # windows below it are padding; they count only in texts that have nothing else
FILTER_BITS = 2048
HASHES = 5
FEATURES = 160  # of one filter; more go to the next
SLICE = 1 << 20  # bytes searched at once
PART_BYTES, LEAST_BYTES = 8 << 20, 1 << 20  # text of a task, and what is not divided further
MAX_PARTS = 100_000
CHANCE = 3.0  # standard deviations of overlap that count as chance

#: fixed-point c log2 c for c equal bytes in a window, and what one more byte adds
_POINT = 1 << 16
_FULL = int(WINDOW * np.log2(WINDOW)) * _POINT
_WEIGHT = np.round(np.array([c * np.log2(c) if c else 0.0 for c in range(WINDOW + 1)]) * _POINT).astype(np.int64)
_STEP = np.diff(_WEIGHT)


# --- windows of bytes -----------------------------------------------------------------------


def entropy_levels(data: np.ndarray) -> np.ndarray:
    """Entropy, in steps of ``LEVELS``, of every window of ``WINDOW`` bytes.

    Sliding by a byte changes the sum of c log c by what the leaving and the entering byte had in common with the others;
    in fixed point, so that equal windows have equal levels wherever they stand.
    """
    n = len(data) - WINDOW + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    before, after = np.zeros(len(data), dtype=np.uint8), np.zeros(len(data), dtype=np.uint8)
    for k in range(1, WINDOW):
        same = (data[k:] == data[:-k]).view(np.uint8)
        before[k:] += same
        after[:-k] += same
    total = np.empty(n, dtype=np.int64)
    total[0] = _WEIGHT[np.bincount(data[:WINDOW], minlength=256)].sum()
    total[1:] = _STEP[before[WINDOW:]] - _STEP[after[: n - 1]]
    np.cumsum(total, out=total)
    return (_FULL - total) * LEVELS // _FULL


def _segments(sizes: Sequence[int]) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """Groups of (text, first and last window searched, first and last window counted), each of about ``SLICE`` bytes.

    A window's votes come from the runs around it, so a cut text is searched a run further on both sides.
    """
    group, held = [], 0
    for text, size in enumerate(sizes):
        windows = size - WINDOW + 1
        for a in range(0, max(windows, 0), SLICE):
            b = min(a + SLICE, windows)
            group.append((text, max(0, a - RUN + 1), min(windows, b + RUN - 1), a, b))
            held += b - a
            if held >= SLICE:
                yield group
                group, held = [], 0
    if group:
        yield group


def _joined(texts: Sequence[bytes], group: list[tuple[int, int, int, int, int]]) -> np.ndarray:
    return np.frombuffer(b"".join(memoryview(texts[t])[x: y + WINDOW - 1] for t, x, y, _, _ in group), dtype=np.uint8)


def level_counts(texts: Sequence[bytes]) -> np.ndarray:
    """Windows of each entropy level in all ``texts``."""
    out = np.zeros(LEVELS + 1, dtype=np.int64)
    for group in _segments([len(t) for t in texts]):
        levels, at = entropy_levels(_joined(texts, group)), 0
        counted = np.zeros(len(levels), dtype=bool)
        for _, x, y, a, b in group:
            counted[at + a - x: at + b - x] = True
            at += y - x + WINDOW - 1
        out += np.bincount(levels[counted], minlength=LEVELS + 1)
    return out


def _selected(texts: Sequence[bytes], ranks: np.ndarray, votes: int) -> list[list[np.ndarray]]:
    """Hashes of the selected windows of each text, in order; those of rank -1 are never selected."""
    out: list[list[np.ndarray]] = [[] for _ in texts]
    for group in _segments([len(t) for t in texts]):
        data = _joined(texts, group)
        rank = ranks[entropy_levels(data)]
        key = np.where(rank < 0, np.int64(1) << 61, rank << np.int64(32)) + np.arange(len(rank))
        best = sliding_min(key, RUN) if len(key) >= RUN else np.empty(0, dtype=np.int64)
        count = np.zeros(len(data), dtype=np.int64)
        votable = np.zeros(len(best), dtype=bool)
        short, at, places = [], 0, []
        for t, x, y, a, b in group:
            runs = y - x - RUN + 1
            if runs > 0:
                votable[at: at + runs] = True
            else:
                short.append(at + int(np.argmin(key[at: at + y - x])))
            places.append((t, at + a - x, at + b - x, min(votes, max(1, len(texts[t]) - WINDOW - RUN + 2))))
            at += y - x + WINDOW - 1
        winners = best[votable]
        winners = winners[winners < np.int64(1) << 61] & 0xFFFFFFFF
        count += np.bincount(winners, minlength=len(data))
        for p in short:
            count[p] += key[p] < np.int64(1) << 61
        need = np.full(len(data), votes, dtype=np.int64)
        inside = np.zeros(len(data), dtype=bool)
        for _, a, b, least in places:
            need[a:b], inside[a:b] = least, True
        chosen = np.flatnonzero(inside & (count >= need))
        lanes = np.ascontiguousarray(data[chosen[:, None] + np.arange(WINDOW)]).view("<u8").astype(np.uint64) if len(chosen) else np.empty((0, WINDOW // 8), np.uint64)
        hashes = np.zeros(len(chosen), dtype=np.uint64)
        for lane in range(lanes.shape[1]):
            hashes = mixed(hashes + lanes[:, lane] * np.uint64(2 * lane + 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        cuts = np.searchsorted(chosen, [p[1:3] for p in places])
        for (t, *_), (a, b) in zip(places, cuts):
            if b > a:
                out[t].append(hashes[a:b])
    return out


def features(texts: Sequence[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Distinct features of each text, in order of their first place.

    A text without a selected window takes all windows that win a run, padding included; one shorter than a window is a
    feature itself; an empty one has none.
    """
    found = _selected(texts, np.where(np.arange(LEVELS + 1) < WEAK_LEVEL, -1, ranks), VOTES)
    without = [i for i, parts in enumerate(found) if not parts and len(texts[i]) >= WINDOW]
    for i, parts in zip(without, _selected([texts[i] for i in without], ranks, 1)):
        found[i] = parts
    out = []
    for text, parts in zip(texts, found):
        if parts:
            hashes = np.concatenate(parts)
            out.append(hashes[np.sort(np.unique(hashes, return_index=True)[1])])
        else:
            out.append(np.frombuffer(hashlib.blake2b(text, digest_size=8).digest() if text else b"", dtype="<u8").astype(np.uint64))
    return out


# --- filters --------------------------------------------------------------------------------


def filters(hashes: np.ndarray) -> np.ndarray:
    """Chained Bloom filters, a row of bytes each: ``FEATURES`` features fill one, then the next is begun."""
    bits = np.zeros((-(-len(hashes) // FEATURES), FILTER_BITS), dtype=np.uint8)
    which = np.arange(len(hashes)) // FEATURES
    for k in range(HASHES):
        bits[which, ((hashes >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1)


def as_text(chain: np.ndarray) -> str:
    return base64.b64encode(chain.tobytes()).decode()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), dtype=np.uint8).reshape(-1, FILTER_BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Overlap of two chains, 0 to 1: every filter of the smaller chain against its best match in the other.

    The bits that two filters share are compared with what filters as full as they share by chance: nothing above that,
    within ``CHANCE`` standard deviations, is 0, all bits of the emptier one is 1. Filters weigh by their bits. Equal chains
    are alike by 1; an empty one is like another empty one only.
    """
    if a.shape == b.shape and np.array_equal(a, b):
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if (np.bitwise_count(a).sum(), a.tobytes()) > (np.bitwise_count(b).sum(), b.tobytes()):
        a, b = b, a
    size_a, size_b = (np.bitwise_count(x).sum(axis=1).astype(np.float64) for x in (a, b))
    right = np.unpackbits(b, axis=1).astype(np.float32)
    total = 0.0
    for at in range(0, len(a), 256):  # blocks, as both chains may be long
        best = np.zeros(len(a[at: at + 256]))
        left, own = np.unpackbits(a[at: at + 256], axis=1).astype(np.float32), size_a[at: at + 256, None]
        for to in range(0, len(b), 4096):
            other = size_b[None, to: to + 4096]
            chance = own * other / FILTER_BITS
            spread = np.sqrt(chance * (1 - own / FILTER_BITS) * (1 - other / FILTER_BITS))
            over = (left @ right[to: to + 4096].T).astype(np.float64) - chance
            most = np.maximum(np.minimum(own, other) - chance, 1e-9)
            best = np.maximum(best, np.where(over > CHANCE * spread, np.minimum(over / most, 1.0), 0.0).max(axis=1))
        total += float((best * own[:, 0]).sum())
    return total / float(size_a.sum())


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter of characters replaced by the first as many of ``following``, or all."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


# --- the operator ---------------------------------------------------------------------------


def rarity(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Rank of every entropy level, rarest first, by its windows in all texts; and the bytes of all texts.

    Tasks send a count for each level they met: ``LEVELS`` + 1 numbers at most.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, size = np.zeros(LEVELS + 1, dtype=np.int64), 0
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(0)]
            counts += level_counts(texts)
            size += sum(map(len, texts))
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *met], pa.int32()), pa.array([size, *counts[met]], pa.int64())], names=["level", "windows"])

    parts = docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "level int, windows long")
    found = {r["level"]: r["windows"] for r in parts.groupBy("level").agg(F.sum("windows").alias("windows")).collect()}
    counts = np.array([found.get(level, 0) for level in range(LEVELS + 1)])
    ranks = np.empty(LEVELS + 1, dtype=np.int64)
    ranks[np.lexsort((np.arange(LEVELS + 1), counts))] = np.arange(LEVELS + 1)
    return ranks, found.get(-1, 0)


def fingerprints(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """(doc_id, n_chars, fingerprint) for each row; nothing is shuffled. Ranks are measured on ``docs`` unless given."""
    sent = shipped(docs.sparkSession, rarity(docs)[0] if ranks is None else ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(1)]
            chains = [as_text(filters(h)) for h in features(texts, opened(sent))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(_decoded(t)) for t in texts], pa.int64()), pa.array(chains, pa.string())],
                names=["doc_id", "n_chars", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_chars long, fingerprint string")


def _decoded(data: bytes) -> str:
    return data.decode("utf-8", "surrogateescape")


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
RESULT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def _results(ids: Sequence[int | None], texts: list[bytes], ranks: np.ndarray) -> pa.RecordBatch:
    """One row for each text but the last, compared with its edited text and with the text after it."""
    read = [_decoded(t) for t in texts]
    changed = [edited(t, u).encode("utf-8", "surrogateescape") for t, u in zip(read, read[1:])]
    chains = [filters(h) for h in features([*texts, *changed], ranks)]
    own, other = chains[: len(texts)], chains[len(texts):]
    return pa.RecordBatch.from_arrays([
        pa.array(ids[:-1], pa.int64()), pa.array([len(t) for t in read[:-1]], pa.int64()),
        pa.array([hashlib.sha256(t).hexdigest() for t in changed], pa.string()),
        pa.array([as_text(c) for c in own[:-1]], pa.string()), pa.array([as_text(c) for c in other], pa.string()),
        pa.array([likeness(a, b) for a, b in zip(own, other)], pa.float64()),
        pa.array([likeness(a, b) for a, b in zip(own, own[1:])], pa.float64())], schema=RESULT)


def edit_comparison(docs: DataFrame, ranks: np.ndarray | None = None) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and likenesses to the edited text and to the next row's text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Rows follow each other by
    doc_id, nulls last, then by two hashes of the text; what is then still equal is a repeated row, whose order does not
    matter. The last row is followed by the first, a single row by itself. Null texts count as empty; an empty text has the
    empty fingerprint. Texts are searched in slices, so a very long one costs its own bytes and a few arrays of a slice.
    Other columns are ignored, whatever their names; an empty table gives no rows.

    Texts are dealt once, by ranges of the order, which also divide a third of the rows with one id. A task works on
    neighbours and leaves its first and last text to a small second step, which joins each last text with the first of the next
    range; the ranges' ends, two for each task, are the only texts that move twice.
    """
    spark = docs.sparkSession
    measured, size = rarity(docs)
    sent = shipped(spark, measured if ranks is None else ranks)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.cast("binary").alias("text")).withColumns({
        "no_id": F.col("doc_id").isNull(), "h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text"), "at": F.monotonically_increasing_id()})
    order = ["no_id", "doc_id", "h1", "h2", "at"]
    parts = 1 + min(MAX_PARTS, max(size // PART_BYTES, min(size // LEAST_BYTES, 4 * spark.sparkContext.defaultParallelism)))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ends_ddl = "kind string, part int, no_id boolean, h1 long, h2 long, at long, text binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, part, first = opened(sent), TaskContext.get().partitionId(), True
        held = None  # the row that waits for the next one
        full = pa.schema([*RESULT, ("kind", pa.string()), ("part", pa.int32()), ("no_id", pa.bool_()), ("h1", pa.int64()),
                          ("h2", pa.int64()), ("at", pa.int64()), ("text", pa.binary())])

        def end(row: dict, kind: str) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{**row, "kind": kind, "part": part}], schema=full)

        for batch in batches:
            if not batch.num_rows:
                continue
            if first:
                yield end(batch.slice(0, 1).to_pylist()[0], "first")
                first = False
            ids = ([held["doc_id"]] if held else []) + batch.column(0).to_pylist()
            texts = ([held["text"]] if held else []) + batch.column(1).to_pylist()
            held = batch.slice(batch.num_rows - 1).to_pylist()[0]
            done = _results(ids, texts, ranks)
            if done.num_rows:
                nulls = [pa.nulls(done.num_rows, f.type) for f in list(full)[len(RESULT) + 1:]]
                yield pa.RecordBatch.from_arrays([*done.columns, pa.array(["row"] * done.num_rows), *nulls], schema=full)
        if held:
            yield end(held, "last")

    found = stored(dealt.mapInArrow(run, f"{RESULT_DDL}, {ends_ddl}"), "digests")
    firsts = found.where("kind = 'first'").select("part", *order).collect()  # a row for each range
    firsts.sort(key=lambda r: (r.no_id, r.doc_id or 0, r.h1, r.h2, r.at))
    if not firsts:
        return found.select(*RESULT.names)
    pairs = spark.createDataFrame([(a.part, b.part) for a, b in zip(firsts, firsts[1:] + firsts[:1])], "part int, next int")
    last = found.where("kind = 'last'").select("part", "doc_id", "text")
    after = found.where("kind = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _results([row["doc_id"], None], [row["text"], row["next_text"]], opened(sent))

    stitched = last.join(pairs, "part").join(after, "next").select("doc_id", "text", "next_text").mapInArrow(stitch, RESULT_DDL)
    return found.where("kind = 'row'").select(*RESULT.names).unionAll(stitched)
