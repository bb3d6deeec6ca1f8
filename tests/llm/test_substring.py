"""Repeated passages against brute force."""

import random

from millrace.llm import substring

SCHEMA = "doc_id long, text string, kept string, mark long, ranges string"


def brute(rows, window):
    texts = sorted({(r[0] if r[0] is not None else 1 << 63, r[1]) for r in rows if r[1] is not None}, key=lambda x: x[0])
    seen, out = {}, {}
    for doc, text in texts:
        words = text.encode().split()
        for i in range(len(words) - window + 1):
            seen.setdefault(tuple(words[i:i + window]), (doc, i))
    for doc, text in texts:
        words = text.encode().split()
        gone = {k for i in range(len(words) - window + 1) if seen[tuple(words[i:i + window])] != (doc, i) for k in range(i, i + window)}
        out[doc, text] = (len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode())
    return [(r[0], *(out[r[0] if r[0] is not None else 1 << 63, r[1]] if r[1] is not None else (0, 0, ""))) for r in rows]


def check(spark, rows, window=20):
    df = spark.createDataFrame([(*r, "clash", 1, None) for r in rows], SCHEMA).repartition(3)
    out = sorted(map(str, map(tuple, substring.without_repeats(df, window).collect())))
    assert out == sorted(map(str, brute(rows, window)))


def test_shared_passages(spark):
    rng = random.Random(5)
    words = [f"wört{i}" for i in range(60)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(15, 60))] for _ in range(6)]
    rows = []
    for i in range(80):
        parts = [[rng.choice(words) for _ in range(rng.randrange(0, 80))]]
        for _ in range(rng.randrange(0, 4)):
            parts += [rng.choice(passages), [rng.choice(words) for _ in range(rng.randrange(0, 30))]]
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(w for p in parts for w in p)))
    rows += [(90, rows[3][1]), (2, rows[2][1]), (None, rows[4][1]), (91, None), (92, ""), (93, " \n"), (94, "a " * 3000), (95, "a b " * 500),
             (96, " ".join(words * 3)), (97, " ".join(words[:19])), (2**63 - 1, rows[6][1]), (None, rows[6][1]), (2**63 - 1, None), (None, None),
             (-5, rows[7][1]), (-(2**63), rows[8][1])]
    check(spark, rows)
    check(spark, rows, window=5)


def test_long_and_hot(spark, monkeypatch):
    """Many copies of a passage, small buckets that must be split, and a text longer than a piece."""
    rng = random.Random(2)
    monkeypatch.setattr(substring, "BUCKET_BYTES", 2000)
    monkeypatch.setattr(substring, "HOT", 1)
    monkeypatch.setattr(substring, "FLUSH_BYTES", 5000)
    passage = " ".join(f"p{i}" for i in range(45))
    rows = [(i, " ".join(f"u{rng.randrange(10**6)}" for _ in range(20)) + " " + passage + " end" + str(i)) for i in range(150)]
    rows.append((500, " ".join(f"v{rng.randrange(10**5)}" for _ in range(180_000)) + " " + passage))
    check(spark, rows)


def test_empty_table(spark):
    assert substring.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
