"""Token counts of the documents in flat token files without an index, from their end-of-document ids."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.files import Blocks, attempt_name, filesystem
from millrace.llm.staging import opened, spread, stored
from millrace.llm.tokens import VOCABULARY, shared_tokenizer
from millrace.session import scratch_path

FILE_BYTES = 64 << 20
BLOCK_TOKENS = 1 << 21


def write_flat(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes each document's ids and the end id, one after the other; returns (path, ordinal, doc_id).

    A task writes files of about ``file_bytes`` named after its attempt. Null and empty texts have no ids but the end.
    """
    _, sent = shared_tokenizer(docs.sparkSession, vocabulary)
    system, place = filesystem(folder)
    system.create_dir(place, recursive=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokenizer = opened(sent)
        end = np.array([tokenizer.end], dtype=tokenizer.dtype).tobytes()
        stream, path, size, n = None, None, 0, 0
        for batch in batches:
            paths, ordinals = [], []
            for text in batch["text"]:
                if stream is None or size >= file_bytes:
                    if stream is not None:
                        stream.close()
                    path = f"{folder}/{attempt_name('tokens', '.bin')}"
                    system, place = filesystem(path)
                    stream, size, n = system.open_output_stream(place, compression=None), 0, 0
                data = tokenizer.encode(text) + end
                stream.write(data)
                paths.append(path)
                ordinals.append(n)
                size, n = size + len(data), n + 1
            yield pd.DataFrame({"path": pd.Series(paths, dtype=object), "ordinal": np.array(ordinals, dtype=np.int64), "doc_id": batch["doc_id"].astype("Int64")})
        if stream is not None:
            stream.close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(rows.mapInPandas(run, "path string, ordinal long, doc_id long"), "flat-documents")


def count_documents(files: DataFrame, end: int, dtype: str = "<u2", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, ordinal, start, n_tokens, ended) for every document of the flat files named in ``files`` (path).

    Files are divided into blocks of ``block_tokens`` ids, which are searched independently and in parallel; a block
    reports where its separators stand. A running maximum over each file's blocks gives the last separator before a
    block, and a running sum the number of documents before it, which stitches documents that cross blocks. Ids after
    the last separator are a document that has not ended; an empty file has none. Repeated and null paths count once
    and never.
    """
    width = np.dtype(dtype).itemsize

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for path in batch["path"]:
                system, place = filesystem(path)
                size = system.get_file_info(place).size
                if size % width:
                    raise ValueError(f"{path}: {size} bytes are no whole number of ids")
                found.append(size // width)
            yield pd.DataFrame({"path": batch["path"], "n": np.array(found, dtype=np.int64)})

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, begin, n in zip(batch["path"], batch["begin"], batch["n"]):
                file = Blocks(path)
                stop = min(begin + block_tokens, n)
                ids = np.frombuffer(file.read(begin * width, (stop - begin) * width), dtype=dtype)
                file.close()
                at = np.flatnonzero(ids == end).astype(np.int64) + begin
                yield pd.DataFrame({"path": [path], "begin": [begin], "n": [n], "ends": [at], "last": pd.array([at[-1] if len(at) else None], dtype="Int64")})

    blocks = (
        files.select("path").where("path is not null").distinct().mapInPandas(sizes, "path string, n long").where("n > 0")
        .select("path", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(block_tokens).cast("long"))).alias("begin"))
    )
    found = stored(spread(blocks, "path", "begin", pieces=blocks.count()).mapInPandas(search, "path string, begin long, n long, ends array<long>, last long"), "flat-blocks")
    order = Window.partitionBy("path").orderBy("begin")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select("path", "begin", "n", F.size("ends").alias("k"), "last").select(
        "path", "begin", F.coalesce(F.sum("k").over(before), F.lit(0)).cast("long").alias("first"),
        (F.coalesce(F.max("last").over(before), F.lit(-1)) + 1).alias("open"),
        F.when(F.lead("begin").over(order).isNull(), F.col("n")).alias("size"))
    rows = found.select("path", "begin", "ends").join(scan, ["path", "begin"])
    ends = rows.select("path", "first", "open", "ends", F.posexplode("ends").alias("i", "at"))
    start = F.when(F.col("i") == 0, F.col("open")).otherwise(F.try_element_at("ends", F.col("i")) + 1)
    ended = ends.select("path", (F.col("first") + F.col("i")).alias("ordinal"), start.alias("start"), (F.col("at") - start).alias("n_tokens"), F.lit(True).alias("ended"))
    last = F.coalesce(F.try_element_at("ends", F.lit(-1)) + 1, F.col("open"))
    rest = rows.where(F.col("size") > last).select(
        "path", (F.col("first") + F.size("ends")).alias("ordinal"), last.alias("start"), (F.col("size") - last).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionAll(rest)


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs``, through flat token files in the shared folder."""
    spark = docs.sparkSession
    tokenizer, _ = shared_tokenizer(spark, vocabulary)
    written = write_flat(docs, scratch_path(spark, "flat-tokens"), vocabulary)
    counts = count_documents(written, tokenizer.end, tokenizer.dtype)
    return written.join(counts, ["path", "ordinal"]).select("doc_id", "n_tokens")
