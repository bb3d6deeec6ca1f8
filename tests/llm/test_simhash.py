"""SimHash near-duplicates against brute force."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import simhash
from millrace.llm.components import connected_components

SCHEMA = "doc_id long, text string, label string, fp string, _row long, root long"


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, limit=4):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= limit:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(values))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_documents_of_all_kinds(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}é" for i in range(400)]
    base = [rng.choice(vocabulary) for _ in range(300)]
    texts = [" ".join(base)] * 3
    for _ in range(30):
        copy = list(base)
        for _ in range(rng.randrange(1, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append("\t".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    texts += [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))) for _ in range(40)]
    texts += [None, "", " \n\t", "one", "one two three", "ONE two THREE", "x " * 70_000]
    rows = [(i, t, None, "clash", 1, 2) for i, t in enumerate(texts)] + [(None, texts[0], None, None, None, None), (5, texts[5], "again", "", 0, 0)]
    out = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    values = [brute_fingerprint(r[1]) for r in rows]
    roots = brute_components(values)
    smallest = {g: min(rows[i][0] for i in range(len(rows)) if roots[i] == g and rows[i][0] is not None) for g in set(roots)}
    want = sorted((str(r[0]), f"{v:016x}", smallest[g]) for r, v, g in zip(rows, values, roots))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in out) == want


@pytest.mark.parametrize("spread", [2, 3])
def test_large_cluster_of_fingerprints(spark, spread):
    """Many fingerprints around one, and chains that only link end to end."""
    rng = random.Random(spread)
    centre = rng.getrandbits(64)
    values = {centre}
    while len(values) < 250:
        x = centre
        for bit in rng.sample(range(64), spread):
            x ^= 1 << bit
        values.add(x)
    chain = rng.getrandbits(64)
    for i in range(0, 40, 4):
        values.add(chain)
        chain ^= 0b1111 << i
    values |= {rng.getrandbits(64) for _ in range(300)} | {0, 1, (1 << 64) - 1}
    values = sorted(values)
    out = simhash.fingerprint_components(spark.createDataFrame([(signed(v),) for v in values], "fp long")).collect()
    found = {r.fp: r.root for r in out}
    groups = brute_components(values)
    pairs = {(groups[i], found[signed(v)]) for i, v in enumerate(values)}
    assert len(out) == len(values) and len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def exploded_and_sent(monkeypatch, work):
    """Plans that ``work`` writes, as they are before any row is counted, in which a table that comes from an explode is sent to all tasks."""
    plans = []

    def seen(df, label):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return stored(df, label)

    stored = simhash.stored
    monkeypatch.setattr(simhash, "stored", seen)
    work()
    exploded = [p for p in plans if "Generate explode" in p]
    assert exploded
    return [p for p in exploded if "BroadcastHashJoin" in p or "BroadcastNestedLoopJoin" in p]


def test_grid_cells_are_not_sent_to_all_tasks(spark, monkeypatch):
    """A small table's cells are many times its rows, and are taken for as few."""
    fps = spark.createDataFrame([(i * 0x9E3779B97F4A7C15 % (1 << 63),) for i in range(300)] + [(1,), (3,), (7,)], "fp long")
    assert not exploded_and_sent(monkeypatch, lambda: simhash.fingerprint_components(fps))


def test_manhattan_distance_is_a_lower_bound(spark):
    rng = random.Random(1)
    pairs = [(rng.getrandbits(64), rng.getrandbits(64)) for _ in range(300)]
    df = spark.createDataFrame([(signed(a), signed(b)) for a, b in pairs], "a long, b long")
    got = df.select("a", "b", F.bit_count(simhash.thermometer(F.col("a")).bitwiseXOR(simhash.thermometer(F.col("b")))).alias("d")).collect()
    for r in got:
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        counts = [sum(abs((a >> i & 3).bit_count() - (b >> i & 3).bit_count()) for i in range(0, 64, 2)), (a ^ b).bit_count()]
        assert r.d == counts[0] <= counts[1]


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(2, 40)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    out = {r.v: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {out[i] for i in range(100, 161)} == {100} and {out[i] for i in range(1, 40)} == {1} and out[200] == out[201] == 200


def test_keep_one_sends_no_grid_cells(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{i * j % 97}" for j in range(1, 30)), "x", "", 0, 0) for i in range(40)], SCHEMA)
    assert not exploded_and_sent(monkeypatch, lambda: simhash.keep_one(docs).collect())


def test_keep_one_and_empty_table(spark):
    rows = [(3, "a b c d e f", "x", "", 0, 0), (1, "a b c d e f", "y", "", 0, 0), (None, "a b c d e f", "z", "", 0, 0), (9, "other words stand here now", "x", "", 0, 0),
            (9, "other words stand here now", "x", "", 0, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = simhash.keep_one(df)
    assert out.columns == df.columns and sorted((r.doc_id, r.label) for r in out.collect()) == [(1, "y"), (9, "x")]
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0
