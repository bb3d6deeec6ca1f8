"""Training-order shards: fixed-length token sequences at the places a keyed permutation gives them."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.files import Blocks, attempt_name, filesystem
from millrace.llm.staging import opened, spread, stored
from millrace.llm.tokens import VOCABULARY, shared_tokenizer
from millrace.llm.words import mixed
from millrace.session import scratch_path

LENGTH = 1024
SHARD_SEQUENCES = 8192
KEY = 20240501
ROUNDS = 6

ID_BYTES = 3  # of text for an id, about; only decides the number of shards
PER_PARTITION = 1 << 32  # sequence numbers kept free for each input partition

WRITTEN = "place long, shard long, path string, start long, n_tokens int, sequence long"


def _rounds(key: int) -> list[np.uint64]:
    return [np.uint64(int.from_bytes(hashlib.sha256(f"{key}/{i}".encode()).digest()[:8], "big")) for i in range(ROUNDS)]


def permuted(values: np.ndarray, n: int, key: int = KEY, inverse: bool = False) -> np.ndarray:
    """A keyed permutation of 0..n-1 (or its inverse), for an array of values and without a table.

    Feistel network over the smallest even number of bits that holds n; a result of n or more is put through again
    until it is below n (cycle-walking), which takes less than four rounds on average and keeps it a bijection.
    """
    half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
    low = (np.uint64(1) << half) - np.uint64(1)
    keys = _rounds(key)

    def network(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        if inverse:
            for k in reversed(keys):
                left, right = right ^ (mixed(left + k) & low), left
        else:
            for k in keys:
                left, right = right, left ^ (mixed(right + k) & low)
        return (left << half) | right

    out = network(np.asarray(values, dtype=np.uint64))
    while len(again := np.flatnonzero(out >= np.uint64(n))):
        out[again] = network(out[again])
    return out.astype(np.int64)


def write_shards(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES,
                 key: int = KEY) -> DataFrame:
    """Tokenises ``docs`` (text) once and writes shards of fixed-stride sequences in training order; returns their
    index (slot, shard, path, start, n_tokens, sequence).

    The documents of each input partition, each followed by the end id, are one stream that is cut into sequences of
    ``length`` ids; the last is filled up with end ids, and n_tokens counts those before. Every partition has a
    range of sequence numbers of its own, so nothing has to be counted first. The permutation of all
    numbers gives each sequence its place; a shard takes a fixed range of places, in order, and the slot is the
    number of sequences at lower places: the shards before it plus the place's rank in its shard. So slots are
    dense, any slot's bytes follow from its shard's first slot and the stride, and a shard's size varies only by chance.

    The order in a partition is the order of reading, so equal runs need a stored table read in the same partitions.
    Ids are shuffled once, by shard. Null and empty texts are documents of no ids; columns other than text
    are ignored; an empty table gives no shards.
    """
    tokenizer, sent = shared_tokenizer(docs.sparkSession, vocabulary)
    width = tokenizer.width
    texts = docs.select(F.col("text").cast("string").alias("text"))
    bounds = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count(F.lit(1))).first()
    shards = max(1, (bounds[0] // ID_BYTES + bounds[1]) // (length * shard_sequences))
    total = texts.rdd.getNumPartitions() * PER_PARTITION
    breadth = -(-total // shards)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer, stride, held = opened(sent), length * width, b""
        stop = np.array([tokenizer.end], dtype=tokenizer.dtype).tobytes()
        number = TaskContext.get().partitionId() * PER_PARTITION

        def rows(data: bytes, used: int) -> pd.DataFrame:
            nonlocal number
            n = len(data) // stride
            sequences = np.arange(number, number + n)
            number += n
            places = permuted(sequences, total, key)
            return pd.DataFrame({"place": places, "shard": places // breadth, "sequence": sequences,
                                 "n_tokens": np.minimum(length, used - length * np.arange(n)).astype(np.int32),
                                 "ids": [data[i * stride: (i + 1) * stride] for i in range(n)]})

        for batch in batches:
            held = b"".join([held, *(tokenizer.encode(text) + stop for text in batch["text"])])
            whole = len(held) // stride * stride
            yield rows(held[:whole], whole // width)
            held = held[whole:]
        if held:
            yield rows(held + stop * ((stride - len(held)) // width), len(held) // width)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream, shard, path, size = None, None, None, 0
        for batch in batches:  # sorted by place
            paths, starts = [], []
            for s, ids in zip(batch["shard"], batch["ids"]):
                if s != shard:
                    if stream is not None:
                        stream.close()
                    shard, path, size = s, f"{folder}/{attempt_name(f'shard-{s:08d}', '.bin')}", 0
                    system, place = filesystem(path)
                    stream = system.open_output_stream(place, compression=None)
                stream.write(ids)
                paths.append(path)
                starts.append(size)
                size += len(ids)
            yield pd.DataFrame({"place": batch["place"], "shard": batch["shard"], "path": pd.Series(paths, dtype=object),
                                "start": np.array(starts, dtype=np.int64), "n_tokens": batch["n_tokens"], "sequence": batch["sequence"]})
        if stream is not None:
            stream.close()

    system, place = filesystem(folder)
    system.create_dir(place, recursive=True)
    rows = texts.mapInPandas(cut, "place long, shard long, sequence long, n_tokens int, ids binary")
    out = rows.repartition("shard").sortWithinPartitions("place").mapInPandas(write, WRITTEN)
    index = stored(out, "training-index")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each shard
    first = index.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    slot = (F.col("first") + F.col("start") / (length * width)).cast("long")
    return index.join(first, "shard").select(slot.alias("slot"), "shard", "path", "start", "n_tokens", "sequence")


def read_shards(index: DataFrame, first_slot: int = 0, length: int = LENGTH, width: int = 2) -> DataFrame:
    """The sequences from ``first_slot`` on: the index without path, and ids (binary), read shard by shard in order.

    A job that stopped resumes by the slot it had reached. Every shard is read sequentially in one task.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        file, path = None, None
        for batch in batches:
            ids = []
            for p, start in zip(batch["path"], batch["start"]):
                if p != path:
                    if file is not None:
                        file.close()
                    file, path = Blocks(p), p
                ids.append(file.read(start, length * width))
            yield batch.drop(columns="path").assign(ids=ids)
        if file is not None:
            file.close()

    chosen = index.where(F.col("slot") >= first_slot)
    shards = chosen.agg(F.max("shard") - F.min("shard") + 1).first()[0] or 1
    return spread(chosen, "shard", pieces=shards).sortWithinPartitions("slot").mapInPandas(
        run, "slot long, shard long, start long, n_tokens int, sequence long, ids binary")


def materialised(docs: DataFrame, vocabulary: str = VOCABULARY, length: int = LENGTH, shard_sequences: int = SHARD_SEQUENCES, key: int = KEY) -> DataFrame:
    """Writes shards to the shared folder and reads them back: one row a sequence, with the SHA-256 of its ids."""
    folder = scratch_path(docs.sparkSession, "training-order")
    index = write_shards(docs, folder, vocabulary, length, shard_sequences, key)
    return read_shards(index, length=length).select(
        "slot", "shard", "start", "sequence", F.col("n_tokens").cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"))
