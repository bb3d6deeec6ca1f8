"""Benchmark items inside documents: size-partitioned MinHash containment search, verified shingle by shingle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.staging import opened, shipped, stored
from millrace.llm.words import WORDLIKE, gram_hashes, word_table

SHINGLE = 5
CONTAINMENT = 0.8
BLOCK_BYTES = 32 << 20  # of item texts that are sent to the tasks at once
FILTER_BITS = 22


@dataclass
class Block:
    """Some benchmark items, as every task holds them; arrays over items are sorted by size."""

    ids: list[int | None]
    grams: list[frozenset[bytes]]
    hashes: list[np.ndarray]
    words_in_gram: np.ndarray  # fewer than SHINGLE for shorter items
    needed: np.ndarray  # smallest number of shingles that reaches the containment
    keys: np.ndarray  # sorted sketch hashes of all items
    owner: np.ndarray  # item of each key
    filter: np.ndarray


def _words(text: bytes | None) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    data = (text or b"").lower()  # bytes: only A-Z change
    return (data, *word_table(data, WORDLIKE))


def _gram(data: bytes, starts: np.ndarray, ends: np.ndarray, i: int, n: int) -> bytes:
    return b" ".join([data[starts[j]: ends[j]] for j in range(i, i + n)])


def _needed(n: int, containment: float) -> int:
    return max(1, int(np.ceil(containment * n - 1e-9)))


def build_block(items: list[tuple[int | None, bytes | None]], shingle: int, containment: float) -> Block:
    """Sketches: of an item's n distinct shingles the n - needed + 1 with the smallest hashes (bottom-k MinHash).

    A document that holds enough of the item's shingles lacks too few to miss all of these, so it shares at least
    one sketch value: no match is lost, whatever the length of the document.
    """
    found = []
    for name, text in items:
        data, starts, ends, words = _words(text)
        n = min(shingle, len(words))
        if n:
            h = gram_hashes(words, n)
            found.append((frozenset(_gram(data, starts, ends, i, n) for i in range(len(h))), np.unique(h), n, name))
    found.sort(key=lambda x: len(x[1]))
    needed = [_needed(len(x[0]), containment) for x in found]
    sketches = [h[: len(grams) - need + 1] for (grams, h, _, _), need in zip(found, needed)]
    keys = np.concatenate(sketches) if sketches else np.empty(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(found)), [len(x) for x in sketches])
    order = np.argsort(keys, kind="stable")
    marks = np.zeros(1 << FILTER_BITS, dtype=bool)
    marks[keys >> np.uint64(64 - FILTER_BITS)] = True
    return Block([x[3] for x in found], [x[0] for x in found], [x[1] for x in found], np.array([x[2] for x in found], dtype=np.int64),
                 np.array(needed, dtype=np.int64), keys[order], owner[order], marks)


def matches(text: bytes | None, block: Block) -> list[tuple[int | None, int, int]]:
    """(item id, shingles found, shingles of the item) of the items that one text contains."""
    data, starts, ends, words = _words(text)
    out = []
    for n in np.unique(block.words_in_gram).tolist():
        h = gram_hashes(words, n)
        hits = np.unique(h[block.filter[h >> np.uint64(64 - FILTER_BITS)]])
        left, right = np.searchsorted(block.keys, hits), np.searchsorted(block.keys, hits, side="right")
        candidates = np.unique(np.concatenate([block.owner[a:b] for a, b in zip(left, right) if b > a] or [block.owner[:0]]))
        # the size partition of the text: larger items than it can hold are no candidates
        candidates = candidates[(block.words_in_gram[candidates] == n) & (block.needed[candidates] <= len(h))]
        if not len(candidates):
            continue
        at = np.flatnonzero(np.isin(h, np.concatenate([block.hashes[c] for c in candidates])))
        here = {_gram(data, starts, ends, i, n) for i in at.tolist()}
        for c in candidates.tolist():
            shared = len(block.grams[c] & here)
            if shared >= block.needed[c]:
                out.append((block.ids[c], shared, len(block.grams[c])))
    return out


def _blocks(benchmark: DataFrame, shingle: int, containment: float) -> Iterator[Block]:
    """The benchmark in blocks of bounded size, one partition of it at a time on the driver."""
    items, held = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("binary")).toLocalIterator():
        items.append((row[0], bytes(row[1]) if row[1] is not None else None))
        held += len(items[-1][1] or b"")
        if held >= BLOCK_BYTES:
            yield build_block(items, shingle, containment)
            items, held = [], 0
    if items:
        yield build_block(items, shingle, containment)


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item) for each document row and item of which it has enough shingles.

    Words are lower-cased runs of ASCII letters, digits and non-ASCII characters, so punctuation, case and spacing
    do not hide a copy; an item of fewer words than a shingle counts as one shingle of all its words. Items are a
    query set against all documents: they go to the tasks in blocks of ``BLOCK_BYTES``, each block reads the
    documents once, and nothing is shuffled. Items and texts that are null, empty or without words match nothing; repeated
    rows on either side give repeated rows; null ids stay null. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    schema = "doc_id long, item_id long, n_shared long, n_item long"

    def finder(sent) -> Callable:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            block = opened(sent)
            for batch in batches:
                found = [(i, *m) for i, t in enumerate(batch["text"]) for m in matches(t, block)]
                at, items, shared, sizes = zip(*found) if found else ((), (), (), ())
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].astype("Int64").iloc[list(at)].to_numpy(dtype=object), "item_id": pd.array(items, dtype="Int64"),
                    "n_shared": np.array(shared, dtype=np.int64), "n_item": np.array(sizes, dtype=np.int64)})

        return run

    parts = []
    for block in _blocks(benchmark, shingle, containment):
        sent = shipped(spark, block)
        if parts:
            parts[-1] = stored(parts[-1], "decontaminate")
        parts.append(rows.mapInPandas(finder(sent), schema))
    if not parts:
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


def without_benchmark(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, containment: float = CONTAINMENT) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns and types stay as they are."""
    spark = docs.sparkSession

    def keeper(sent) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = opened(sent)
            for batch in batches:
                texts = batch.column(batch.schema.get_field_index("text")).cast(pa.binary()).to_pylist()
                yield batch.filter(pa.array([not matches(t, block) for t in texts], type=pa.bool_()))

        return run

    for block in _blocks(benchmark, shingle, containment):
        docs = docs.mapInArrow(keeper(shipped(spark, block)), docs.schema)
    return docs
