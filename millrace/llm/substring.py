"""Repeated passages: windows of consecutive words that start earlier elsewhere, found bucket by bucket."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import stored
from millrace.llm.words import NOT_SPACE, gram_hashes, mixed, sliding_min, span_hashes, spans, word_table

WINDOW = 20
GRAM = 3  # words in a minimiser
RUN = 256  # windows that travel as one string at most
BUCKET_BYTES = 2 << 20  # of packed strings, on average
HOT = 8  # times BUCKET_BYTES from which a bucket is split
FLUSH_BYTES = 4 << 20  # of text whose strings a task holds at once
NULL_ID = (1 << 63) - 1  # null ids come last, and after the greatest id by
NULL_MARK = 1 << 33  # which their marks exceed all others

RUNS = "bucket long, docs binary, marks binary, starts binary, packed binary"
RANGES = "doc long, mark long, start long, stop long"


def _lows(words: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimiser of every window, and a second one by another order of the same grams."""
    grams = gram_hashes(words, gram)
    return sliding_min(grams, window - gram + 1), sliding_min(mixed(grams ^ np.uint64(0x5851F42D4C957F2D)), window - gram + 1)


def _bucket(low: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(low + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def _cut(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last + 1 of the runs of equal keys, none over RUN long."""
    n = len(keys[0])
    change = np.zeros(n, dtype=bool)
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    change[0] = True
    first = np.flatnonzero(change)
    length = np.diff(np.append(first, n))
    if length.max() > RUN:
        pieces = (length + RUN - 1) // RUN
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + nth * RUN
    return first, np.append(first[1:], n)


def _super_runs(words: np.ndarray, window: int, gram: int, buckets: int, hot: np.ndarray, parts: np.ndarray) -> tuple[np.ndarray, ...]:
    """(bucket, first window, last window + 1) of consecutive windows that share a minimiser.

    Windows of a hot bucket are dealt on to ``parts`` of it by their second minimiser; equal windows have equal
    minimisers, so they always meet.
    """
    low, second = _lows(words, window, gram)
    bucket = _bucket(low, buckets)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, bucket), len(hot) - 1)
        is_hot = hot[at] == bucket
        part = (mixed(second) % parts[at].astype(np.uint64)).astype(np.int64) + 1
        bucket = np.where(is_hot, bucket + buckets * part, bucket)
        low = np.where(is_hot, second, low)
    first, last = _cut(low, bucket)
    return bucket[first], first, last


def _normal(text: bytes | None) -> bytes:
    return b" ".join((text or b"").split())  # bytes: ASCII white space only


def _loads(window: int, gram: int, buckets: int) -> Callable:
    none = np.empty(0, dtype=np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, int] = {}
        for batch in batches:
            for text in batch["text"]:
                starts, ends, words = word_table(_normal(text))
                if len(words) < window:
                    continue
                bucket, first, last = _super_runs(words, window, gram, buckets, none, none)
                weight = ends[last + window - 2] - starts[first]
                names, at = np.unique(bucket, return_inverse=True)
                for k, v in zip(names.tolist(), np.bincount(at, weight).tolist()):
                    seen[k] = seen.get(k, 0) + int(v)
            if len(seen) > 500_000:
                yield pd.DataFrame({"bucket": list(seen), "load": list(seen.values())})
                seen = {}
        yield pd.DataFrame({"bucket": np.array(list(seen), dtype=np.int64), "load": np.array(list(seen.values()), dtype=np.int64)})

    return run


def _pack(window: int, gram: int, buckets: int, hot: np.ndarray, parts: np.ndarray) -> Callable:
    squeeze = lambda a: zstandard.ZstdCompressor(level=3).compress(a)

    def emitted(best: dict, again: list) -> pd.DataFrame:
        by_bucket: dict[int, list] = {}
        for packed, (doc, mark, start, bucket) in best.items():
            by_bucket.setdefault(bucket, []).append((doc, mark, start, packed))
        rows = [
            (b, *(squeeze(np.array(c, dtype=np.int64).tobytes()) for c in list(zip(*found))[:3]), squeeze(b"\n".join(x[3] for x in found)))
            for b, found in by_bucket.items()
        ]
        if again:  # known to be repeats already: whole ranges, with their lengths in place of the strings
            docs, marks, starts, lengths = (np.array(c, dtype=np.int64).tobytes() for c in zip(*again))
            rows.append((-1 - int(again[0][1]) % 4096, squeeze(docs), squeeze(marks), squeeze(starts), squeeze(lengths)))
        return pd.DataFrame(rows, columns=["bucket", "docs", "marks", "starts", "packed"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: dict[bytes, tuple] = {}
        again: list[tuple] = []
        held = 0
        for batch in batches:
            for doc, mark, text in zip(batch["doc"].tolist(), batch["mark"].tolist(), batch["text"]):
                data = _normal(text)
                starts, ends, words = word_table(data)
                if len(words) < window:
                    continue
                bucket, first, last = _super_runs(words, window, gram, buckets, hot, parts)
                begin, end = starts[first].tolist(), ends[last + window - 2].tolist()
                for b, i, j, s, e in zip(bucket.tolist(), first.tolist(), last.tolist(), begin, end):
                    packed = data[s:e]
                    new, old = (doc, mark, i, b), best.get(packed)
                    if old is None:
                        best[packed] = new
                    elif new != old:  # else a row that repeats another
                        best[packed] = min(new, old)
                        again.append((*max(new, old)[:3], j - i + window - 1))
                held += len(data)
                if held >= FLUSH_BYTES:
                    yield emitted(best, again)
                    best, again, held = {}, [], 0
        if best or again:
            yield emitted(best, again)

    return run


def _repeats(data: bytes, docs: np.ndarray, marks: np.ndarray, starts: np.ndarray, window: int) -> pd.DataFrame:
    """Word ranges of the windows in one bucket that have an earlier equal window.

    ``data`` holds one packed string a line. Windows are sorted by (hash, document, start); equal hashes are then
    compared byte by byte with the first of their group, and groups that differ are told apart by the bytes.
    """
    raw = np.frombuffer(data, dtype=np.uint8)
    begin, end = spans(raw, NOT_SPACE)
    line = np.searchsorted(np.flatnonzero(raw == 10), begin)
    at = np.flatnonzero(line[: len(line) - window + 1] == line[window - 1:]) if len(line) >= window else np.empty(0, dtype=np.int64)
    if not len(at):
        return pd.DataFrame({"doc": [], "mark": [], "start": [], "stop": []}, dtype="int64")
    first_word = np.searchsorted(line, np.arange(len(docs)))
    doc, mark, pos = docs[line[at]], marks[line[at]], starts[line[at]] + at - first_word[line[at]]
    s, e = begin[at], end[at + window - 1]
    h = span_hashes(raw, s, e)
    order = np.lexsort((pos, mark, doc, h))
    h, head = h[order], np.arange(len(order))
    head[1:][h[1:] == h[:-1]] = 0
    head = np.maximum.accumulate(head)  # place in ``order`` of the first of the same hash
    rest = np.flatnonzero(head != np.arange(len(order)))
    lead = order[head[rest]]
    rest = order[rest]
    same = np.fromiter(
        (data[a:b] == data[c:d] for a, b, c, d in zip(s[rest].tolist(), e[rest].tolist(), s[lead].tolist(), e[lead].tolist())),
        dtype=bool, count=len(rest))
    if not same.all():  # another window has the same hash: its groups by their bytes
        leads: dict[bytes, int] = {}
        for k in np.flatnonzero(~same).tolist():  # in order
            lead[k] = leads.setdefault(data[s[rest[k]]: e[rest[k]]], rest[k])
    later = (doc[lead] != doc[rest]) | (mark[lead] != mark[rest]) | (pos[lead] != pos[rest])
    gone = np.sort(rest[later])
    if not len(gone):
        return pd.DataFrame({"doc": [], "mark": [], "start": [], "stop": []}, dtype="int64")
    lines = line[at[gone]]
    new = np.ones(len(gone), dtype=bool)
    new[1:] = (np.diff(at[gone]) != 1) | (np.diff(lines) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(gone)) - 1
    return pd.DataFrame({
        "doc": doc[gone[first]], "mark": marks[lines[first]], "start": pos[gone[first]], "stop": pos[gone[last]] + window})


def _resolve(window: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened = zstandard.ZstdDecompressor().decompress
        numbers = lambda cells: np.frombuffer(b"".join(map(opened, cells)), dtype=np.int64)
        now, rows = None, []

        def done() -> pd.DataFrame:
            docs, marks, starts, packed = zip(*rows)
            docs, marks, starts = numbers(docs), numbers(marks), numbers(starts)
            if now < 0:
                return pd.DataFrame({"doc": docs, "mark": marks, "start": starts, "stop": starts + numbers(packed)})
            return _repeats(b"\n".join(map(opened, packed)), docs, marks, starts, window)

        for batch in batches:  # sorted by bucket
            for bucket, *cells in batch.itertuples(index=False):
                if rows and (bucket != now or now < 0):
                    yield done()
                    rows = []
                now = bucket
                rows.append(cells)
        if rows:
            yield done()

    return run


def _doc() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID))


def _mark() -> Column:
    mark = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(1 << 32).cast("long"))
    return F.when(F.col("doc_id").cast("long").isNull(), mark + NULL_MARK).otherwise(mark)


def repeated_ranges(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc, mark, start, stop): ranges of words covered by windows that start earlier elsewhere; they may overlap.

    Super-k-mers: consecutive windows with the same minimiser travel as one string, about a tenth of the rows and a
    seventh of the bytes of separate windows. Strings that a task meets again are settled there, so a passage that
    a third of the documents share is one row a task. Buckets hold a few MB; those of frequent minimisers, counted
    over all documents first, are split by a second minimiser.
    """
    texts = docs.select(_doc().alias("doc"), _mark().alias("mark"), F.col("text").cast("binary").alias("text")).where("text is not null")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(total * 3 // BUCKET_BYTES) + 1
    loads = texts.select("text").mapInPandas(_loads(window, gram, buckets), "bucket long, load long")
    heavy = loads.groupBy("bucket").agg(F.sum("load").alias("load")).where(F.col("load") > HOT * BUCKET_BYTES)
    found = sorted((r.bucket, -(-r.load // BUCKET_BYTES)) for r in heavy.collect())  # at most total / HOT / BUCKET_BYTES rows
    hot, parts = (np.array([x[i] for x in found], dtype=np.int64) for i in (0, 1))
    runs = texts.mapInPandas(_pack(window, gram, buckets, hot, parts), RUNS)
    return runs.repartition("bucket").sortWithinPartitions("bucket").mapInPandas(_resolve(window), RANGES)


def _strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for text, ranges in zip(batch["text"], batch["ranges"]):
            words = (text or b"").split()
            kept, at = [], 0
            for r in ranges if ranges is not None else ():
                kept += words[at: r["start"]]
                at = max(at, r["stop"])
            kept += words[at:]
            rows.append((len(words), len(words) - len(kept), b" ".join(kept).decode()))
        out = pd.DataFrame(rows, columns=["n_words", "n_removed", "kept"])
        out.insert(0, "doc", batch["doc"].to_numpy())
        out.insert(1, "mark", batch["mark"].to_numpy())
        yield out


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): every document's words that no earlier equal window covers.

    Words are runs of anything but ASCII white space, unchanged; kept words are joined by one space. A window is
    earlier if its doc_id is smaller, or in the same document its start. Every row gives one row: null texts have no
    words; a null doc_id comes after all others; rows that repeat a doc_id with the same text are one document and
    get the same result; of rows with the same doc_id and other texts that with the smaller CRC-32 counts as the
    earlier document. Other columns are ignored.
    """
    ranges = stored(repeated_ranges(docs, window, gram), "substring-ranges")
    by_doc = ranges.groupBy("doc", "mark").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("ranges"))
    texts = docs.select(_doc().alias("doc"), _mark().alias("mark"), F.col("text").cast("binary").alias("text"))
    out = texts.join(by_doc, ["doc", "mark"], "left").select("doc", "mark", "text", "ranges").mapInPandas(
        _strip, "doc long, mark long, n_words long, n_removed long, kept string")
    return out.select(F.when(F.col("mark") < NULL_MARK, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept")


def digest(kept: Column) -> Column:
    return F.sha2(kept.cast("binary"), 256)
