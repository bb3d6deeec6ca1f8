"""Digests against loops over single windows, and likenesses of texts whose relation is known."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from millrace.llm import digest
from millrace.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, fingerprint string, n_chars string, kind string, part string"


def level(window):
    total = sum(int(np.round(c * math.log2(c) * (1 << 16))) for c in Counter(window).values())
    full = 64 * 6 * (1 << 16)
    return (full - total) * 1000 // full


def winners(data, ranks, weak):
    """Votes of each window: every run of 64 windows votes for the leftmost of its rarest ones."""
    levels = [level(data[i: i + 64]) for i in range(len(data) - 63)]
    keys = [ranks[x] if weak or x >= 100 else math.inf for x in levels]
    votes = Counter()
    for r in range(max(1, len(levels) - 63)):
        run = keys[r: r + 64]
        if min(run) < math.inf:
            votes[r + run.index(min(run))] += 1
    return votes, min(16, max(1, len(levels) - 63))


def brute_windows(data, ranks):
    """The distinct selected windows, in order."""
    if len(data) < 64:
        return [data] if data else []
    votes, need = winners(data, ranks, False)
    places = sorted(p for p, v in votes.items() if v >= need)
    if not places:
        places = sorted(winners(data, ranks, True)[0])
    return list(dict.fromkeys(data[p: p + 64] for p in places))


def prose(rng, n):
    words = [rng.choice("bcdfglmnprst") + rng.choice("aeiou") + rng.choice(["", "n", "r", "stle", "é"]) for _ in range(300)]
    return " ".join(rng.choice(words) for _ in range(n))


def texts():
    rng = random.Random(8)
    out = [prose(rng, rng.choice([1, 3, 20, 40, 200, 500])).encode() for _ in range(25)]
    return out + [b"", b"#" * 500, b"x" * 64, b"ab" * 40, b"short", bytes(range(256)) * 2, out[0], (b"line\n" * 60), prose(rng, 20).encode()[:100], prose(rng, 40).encode()[:130]]


@pytest.mark.parametrize("size", [1 << 20, 150, 64, 1])
def test_features_against_brute_force(monkeypatch, size):
    monkeypatch.setattr(digest, "SLICE", size)
    data = texts() if size > 1 else texts()[-8:]
    counts = digest.level_counts(data)
    want = Counter(level(t[i: i + 64]) for t in data for i in range(len(t) - 63))
    assert {i: c for i, c in enumerate(counts.tolist()) if c} == want
    order = sorted(range(1001), key=lambda x: (want[x], x))
    ranks = np.empty(1001, dtype=np.int64)
    ranks[order] = np.arange(1001)
    found = digest.features(data, ranks)
    hashes = {}
    for t, h in zip(data, found):
        windows = brute_windows(t, ranks)
        assert len(windows) == len(h)
        for w, x in zip(windows, h.tolist()):
            assert hashes.setdefault(w, x) == x  # one hash a window, in every text
    assert len(set(hashes.values())) == len(hashes)


def test_filters_and_their_text():
    rng = np.random.default_rng(2)
    h = rng.integers(0, 1 << 63, 401, dtype=np.uint64)
    chain = digest.filters(h)
    assert chain.shape == (3, 256)
    for i in range(3):
        want = {int(x) >> 11 * k & 2047 for x in h[160 * i: 160 * i + 160] for k in range(5)}
        assert set(np.flatnonzero(np.unpackbits(chain[i]))) == want
    assert np.array_equal(digest.from_text(digest.as_text(chain)), chain)
    assert digest.as_text(digest.filters(h[:0])) == "" and len(digest.from_text("")) == 0


def test_likeness(monkeypatch):
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    a, b = digest.filters(h[:1000]), digest.filters(h[2000:])
    none = digest.filters(h[:0])
    assert digest.likeness(a, a) == 1.0 and digest.likeness(none, none) == 1.0 and digest.likeness(a, none) == digest.likeness(none, a) == 0.0
    assert digest.likeness(a, b) < 0.05
    for kept in (800, 480, 160):
        other = digest.filters(np.concatenate([h[:kept], h[2000: 2000 + 1000 - kept]]))
        assert abs(digest.likeness(a, other) - kept / 1000) < 0.08
        assert digest.likeness(a, other) == digest.likeness(other, a)
    assert digest.likeness(digest.filters(h[:320]), a) == 1.0  # a part
    whole = digest.likeness(a, b)
    for p in (digest.filters(h[:5]), digest.filters(h[:400])):
        assert 0.0 <= digest.likeness(p, b) <= 1.0
    assert digest.likeness(a, b) == whole


def chained(rows):
    """Pairs of rows that follow each other, as multisets of (id, text, edited text)."""
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[3]))
    out = []
    for (i, t, *_), (_, u, *_) in zip(order, order[1:] + order[:1]):
        q = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - q] + u[:q]).encode()).hexdigest()))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(11)
    rows = [(rng.randrange(60), prose(rng, rng.choice([0, 1, 2, 30, 300])) + rng.choice(["", "é語𝒜"])) for _ in range(60)]
    rows += [(None, "no id"), (None, None), (None, ""), (3, None), (3, ""), (500, "long text, " * 40_000), (-4, "x"), (2**63 - 1, "y")]
    return rows + [(17, "copied row " * 50)] * 40


@pytest.mark.parametrize("parts", [1, 5])
def test_order_and_edits(spark, monkeypatch, parts):
    monkeypatch.setattr(digest, "LEAST_BYTES", 1000 if parts > 1 else 1 << 40)
    rows = odd_rows()
    df = spark.createDataFrame([(*r, "clash", "clash", "clash", "clash") for r in rows], SCHEMA).repartition(parts)
    found = digest.edit_comparison(df).collect()
    hashes = df.selectExpr("doc_id", "coalesce(text, '') AS t", "cast(coalesce(text, '') AS binary) AS b").selectExpr("doc_id", "t", "xxhash64(b)", "xxhash64(1, b)")
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in found], key=str) == chained([tuple(r) for r in hashes.collect()])
    assert all(0.0 <= r.near_edited <= 1.0 and 0.0 <= r.near_next <= 1.0 for r in found)
    copies = [r for r in found if r.doc_id == 17 and r.n_chars == 550]
    assert len({r.fingerprint for r in copies}) == 1 and [r.near_next for r in copies].count(1.0) >= 39
    single = {(r.doc_id, r.n_chars, r.fingerprint) for r in digest.fingerprints(df).collect()}
    assert {(r.doc_id, r.n_chars, r.fingerprint) for r in found} == single


def test_single_row_and_empty_table(spark):
    one = digest.edit_comparison(spark.createDataFrame([(1, "abcdefgh" * 32)], "doc_id int, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(("abcdefgh" * 32).encode()).hexdigest()
    assert digest.edit_comparison(spark.createDataFrame([], "doc_id int, text string")).count() == 0
    null = digest.edit_comparison(spark.createDataFrame([(1, None)], "doc_id int, text string")).collect()
    assert null[0].fingerprint == "" and null[0].near_next == 1.0 and null[0].n_chars == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op12_digest"](spark, sf).collect()}
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert len(found) == len(docs)
    for (i, t), (j, u) in zip(docs, docs[1:] + docs[:1]):
        q = len(t) // 4
        assert (found[i].n_chars, found[i].edited_sha256) == (len(t), hashlib.sha256((t[: len(t) - q] + u[:q]).encode()).hexdigest())
        a, b, e = (np.frombuffer(base64.b64decode(x), np.uint8).reshape(-1, 256) for x in (found[i].fingerprint, found[j].fingerprint, found[i].edited_fingerprint))
        assert found[i].near_next == digest.likeness(a, b) and found[i].near_edited == digest.likeness(a, e)
        if t == u:
            assert found[i].near_next == 1.0
    by_text = {}
    for i, t in docs:
        assert by_text.setdefault(t, found[i].fingerprint) == found[i].fingerprint
    long = [found[i] for i, t in docs if len(t) > 2000]
    assert np.median([r.near_edited for r in long]) > 0.6 and min(r.near_edited for r in long) > 0.3
    other = [found[i].near_next for (i, t), (_, u) in zip(docs, docs[1:]) if len(t) > 2000 and len(u) > 2000]
    assert np.median(other) < 0.1
