"""Benchmark containment against brute force."""

import random
import re

import pytest

from millrace.llm import decontaminate

DOCS = "doc_id long, text string, item_id long, n_item string, value string"
ITEMS = "item_id long, text string, doc_id long"


def grams(text, n=5):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    n = min(n, len(words))
    return n, {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def brute(docs, items):
    out = []
    for doc, text, *_ in docs:
        for item, item_text, *_ in items:
            n, want = grams(item_text)
            have = {tuple(w[i:i + n]) for w in [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))]
                    for i in range(len(w) - n + 1)} if n else set()
            shared = len(want & have)
            if want and shared >= 0.8 * len(want) - 1e-9:
                out.append((doc, item, shared, len(want)))
    return sorted(out, key=str)


def data():
    rng = random.Random(8)
    words = [f"wo{i}é" for i in range(50)] + [f"x{i}" for i in range(50)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))), 1) for i in range(40)]
    docs = []
    for i in range(120):
        parts = [rng.choice(words) for _ in range(rng.randrange(0, 300))]
        for _ in range(rng.randrange(0, 3)):
            copy = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 0, 1])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            if rng.random() < 0.2:  # only a piece, or with other marks and case
                copy = copy[: max(1, int(len(copy) * 0.85))]
            copy = [w.upper() if rng.random() < 0.2 else w + rng.choice(["", ",", "!!"]) for w in copy]
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = copy
        docs.append((i, rng.choice([" ", "\n", "\t "]).join(parts), 5, "clash", "kept"))
    docs += [(200, None, 1, "", ""), (201, "", 1, "", ""), (None, items[0][1], 1, "", ""), (3, docs[3][1], 1, "", ""), (202, "y " * 400_000 + items[9][1], 1, "", "")]
    items += [(50, None, 1), (51, "", 1), (52, "...", 1), (None, items[3][1], 1), (53, items[4][1], 1)]
    return docs, items


@pytest.mark.parametrize("block", [1 << 20, 600])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs, items = data()
    df, bench = spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS)
    want = brute(docs, items)
    assert len(want) > 15
    assert sorted(map(tuple, decontaminate.contaminated(df, bench).collect()), key=str) == want
    bad = {str((d,)) for d, *_ in want}
    kept = decontaminate.without_benchmark(df, bench)
    assert kept.schema == df.schema
    assert sorted(map(str, kept.collect())) == sorted(str(r) for r in df.collect() if str((r.doc_id,)) not in bad)


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([(1, "a b c", 1)], ITEMS)
    assert decontaminate.contaminated(docs, some).count() == 0
    assert decontaminate.contaminated(spark.createDataFrame([(1, "a b c", 1, "", "")], DOCS), items).count() == 0
    assert decontaminate.without_benchmark(docs, items).count() == 0
