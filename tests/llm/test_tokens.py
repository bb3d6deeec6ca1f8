"""Token shards and flat token files against the tokenizer itself."""

import random

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import separators, tokens, training_order
from millrace.session import scratch_path

SCHEMA = "doc_id long, text string, path string, slot long, tokens string"


def reference():
    tokenizer = tokens.Tokenizer(open(tokens.VOCABULARY, "rb").read())
    return tokenizer, tokenizer.ids


def rows():
    rng = random.Random(4)
    words = ["the", "Éàü", "it's", "don't", "12", "%%%", "ñandú", "\n", "  ", "word,", "日本語"]
    out = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 400))), "clash", 1, "clash") for i in range(60)]
    return out + [(100, None, None, None, None), (101, "", "", 0, ""), (None, "one two", "", 0, ""), (5, out[5][1], "", 0, ""), (102, "long text " * 30_000, "", 0, "")]


def test_encoding_equals_the_library(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE_CHARS", 100)
    tokenizer, encode = reference()
    rng = random.Random(7)
    spaced = ["".join(rng.choice(["a", "É", "7", ".", "'s", " ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "²", "語"][: 14 if i % 3 else 8]) for _ in range(rng.randrange(0, 60)))
              for i in range(3000)]
    for text in [r[1] for r in rows()] + spaced:
        assert np.frombuffer(tokenizer.encode(text), dtype=tokenizer.dtype).tolist() == encode(text or "")


@pytest.mark.parametrize("n", [1, 2, 3, 17, 256, 1000, 4097])
def test_permutation(n):
    slots = training_order.permuted(np.arange(n), n)
    assert sorted(slots.tolist()) == list(range(n))
    assert training_order.permuted(slots, n, inverse=True).tolist() == list(range(n))
    if n > 200:
        assert (training_order.permuted(np.arange(n), n, key=1) != slots).mean() > 0.9
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.2


def test_shards_hold_every_token_at_its_slot(spark):
    tokenizer, encode = reference()
    df = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    path = scratch_path(spark, "order-test")
    df.write.parquet(path)
    docs = spark.read.parquet(path)
    index = training_order.write_shards(docs, scratch_path(spark, "shards"), length=64, shard_sequences=50)
    found = training_order.read_shards(index, length=64).orderBy("slot").collect()
    n = len(found)
    assert [r.slot for r in found] == list(range(n)) and len({r.shard for r in found}) > 3
    first = {}
    for r in found:
        assert r.start == (r.slot - first.setdefault(r.shard, r.slot)) * 128
    total = docs.rdd.getNumPartitions() * training_order.PER_PARTITION
    places = training_order.permuted(np.array([r.sequence for r in found]), total).tolist()
    assert places == sorted(places)
    streams = {}
    for r in docs.select(F.spark_partition_id().alias("p"), "text").collect():
        streams.setdefault(r.p, []).extend([*encode(r.text or ""), tokenizer.end])
    want = []
    for p in sorted(streams):
        for i in range(0, len(streams[p]), 64):
            piece = streams[p][i:i + 64]
            want.append((p * training_order.PER_PARTITION + i // 64, len(piece), piece + [tokenizer.end] * (64 - len(piece))))
    by_number = sorted(found, key=lambda r: r.sequence)
    assert [(r.sequence, r.n_tokens, np.frombuffer(r.ids, dtype="<u2").tolist()) for r in by_number] == want
    later = training_order.read_shards(index, first_slot=n - 7, length=64).collect()
    assert sorted(r.slot for r in later) == list(range(n - 7, n))


def test_token_counts(spark):
    _, encode = reference()
    out = separators.token_counts(spark.createDataFrame(rows(), SCHEMA).repartition(3)).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in out), key=str) == sorted(((r[0], len(encode(r[1] or ""))) for r in rows()), key=str)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1000])
def test_blocks_are_stitched(spark, tmp_path, block):
    rng = random.Random(block)
    files, want = [], []
    for name in ("a", "b", "c", "d", "empty"):
        n = 0 if name == "empty" else rng.randrange(1, 60)
        ids = [rng.choice([1, 2, 3, 9, 9]) for _ in range(n)]
        path = str(tmp_path / name)
        np.array(ids, dtype="<u4").tofile(path)
        files.append(path)
        start = ordinal = 0
        for i, x in enumerate(ids):
            if x == 9:
                want.append((path, ordinal, start, i - start, True))
                start, ordinal = i + 1, ordinal + 1
        if start < n:
            want.append((path, ordinal, start, n - start, False))
    df = spark.createDataFrame([(f,) for f in [*files, files[0]]] + [(None,)], "path string")
    out = separators.count_documents(df, 9, "<u4", block).collect()
    assert sorted((r.path, r.ordinal, r.start, r.n_tokens, r.ended) for r in out) == sorted(want)


def test_empty_tables_and_broken_files(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    assert separators.token_counts(none).count() == 0 and training_order.materialised(none).count() == 0
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="no whole number of ids"):
        separators.count_documents(spark.createDataFrame([(str(tmp_path / "odd"),)], "path string"), 9).collect()
