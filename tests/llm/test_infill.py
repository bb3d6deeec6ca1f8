"""Fill-in-the-middle against slicing and regular expressions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import infill

SCHEMA = "doc_id long, text string, n string, form string, output_sha256 string, pieces string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n, h = len(units), hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i: i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def odd_rows():
    rng = random.Random(3)
    parts = ["word", "Éàü", " ", "\n", "<", ">", "P>", "<S", "12", "日本語", "x", "́", "𝒜", "'", "<<M"]
    out = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 40)))) for i in range(200)]
    out += [(200, None), (201, ""), (None, None), (None, "one two"), (None, "one two"), (5, out[5][1]), (5, "other"), (202, "a<M>b"),
            (203, "word, 語 " * 60_000), (-7, "negative id"), (9223372036854775807, "greatest id")]
    return [(i, t, "clash", None, "clash", "clash") for i, t in out]


def test_against_brute_force(spark):
    rows = odd_rows()
    found = infill.fill_in_middle(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "pieces", "output"]
    have = found.collect()
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in have], key=key) == sorted([brute(r[0], r[1]) for r in rows], key=key)
    assert {r.form for r in have} == {"plain", "psm", "spm"}
    assert all(r.output_sha256 == sha(r.output) for r in have)
    assert sorted(r.restored_sha256 for r in have) == sorted(sha(r[1] or "") for r in rows)


def test_pieces_describe_the_output(spark):
    rows = {i: t for i, t, *_ in odd_rows() if i is not None and 5 < i < 203}
    for r in infill.fill_in_middle(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect():
        buffers = ((rows[r.doc_id] or "").encode(), infill.SENTINELS)
        assert b"".join(buffers[p.buffer][p.start: p.start + p.length] for p in r.pieces).decode() == r.output


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id int, text string, pieces int")
    assert infill.fill_in_middle(none, outputs=False).count() == 0


@pytest.mark.parametrize("block", [1, 2, 7])
def test_blocks_of_long_texts(monkeypatch, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    for i, t, *_ in odd_rows():
        if t and len(t) < 1000:
            form, n, prefix, middle, table = infill.transformed(i, t.encode(), 10, 20)
            assert (i, n, form, prefix, middle, table.bytes().decode()) == brute(i, t)


def test_cut_and_arrange():
    table = infill.PieceTable((b"abcdef", b"XY"), [(0, 0, 3), (1, 0, 2), (0, 3, 3)])
    assert table.bytes() == b"abcXYdef"
    for a in range(9):
        for b in range(a, 9):
            parts = table.cut(a, b)
            assert [p.bytes() for p in parts] == [b"abcXYdef"[:a], b"abcXYdef"[a:b], b"abcXYdef"[b:]]
            back = table.arranged([parts[2].pieces, parts[0].pieces, parts[1].pieces])
            assert back.sha256() == hashlib.sha256(back.bytes()).hexdigest()


def test_shares_are_parameters(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b c d e").alias("text"))
    assert {r.form for r in infill.fill_in_middle(docs, 0, 100).collect()} == {"spm"}
    assert {r.form for r in infill.fill_in_middle(docs, 100, 0).collect()} == {"plain"}
