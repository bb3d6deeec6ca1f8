"""WARC round trips, and what the salvage reader makes of damaged files."""

import gzip
import hashlib
import random

import pytest

from millrace.llm import warc
from millrace.session import scratch_path

SCHEMA = "page_id long, url string, html string, digest string, payload string, first long"


def want(rows):
    digests = [hashlib.sha256((r[2] or "").encode()).hexdigest() for r in rows]
    out = []
    for r, d in zip(rows, digests):
        size = len((r[2] or "").encode())
        same = [x[0] for x, e in zip(rows, digests) if e == d and x[0] is not None]
        first = min(same) if size >= 100 and digests.count(d) > 1 and same else None
        to = first if first is not None and r[0] != first else None
        out.append((r[0], size, d, "response" if to is None else "revisit", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("compressed", [True, False])
def test_round_trip_of_all_kinds(spark, compressed):
    page = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(3, "http://a/ b", page), (1, "http://a/\n", page), (2, None, page), (None, "u", page), (7, "u", None), (8, "", ""), (9, "u", "short"),
            (10, "u", "short"), (1, "http://a/\n", page), (None, "u", "x" * 200), (None, "v", "x" * 200), (12, "u", "y" * 3_000_000), (13, "u", "y" * 3_000_000)]
    df = spark.createDataFrame([(*r, "clash", "clash", 5) for r in rows], SCHEMA).repartition(3)
    files = warc.write_archives(df, scratch_path(spark, "warc-test"), compressed=compressed, archive_bytes=2000)
    out = warc.read_archives(files).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out), key=str) == want(rows)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert warc.round_trip(none).count() == 0


def archive(tmp_path, compressed, n=30):
    rng = random.Random(1)
    parts = []
    for i in range(n):
        payload = bytes(rng.choice(b"abcdef <>\n") for _ in range(rng.randrange(200, 900)))
        record = warc.record_bytes(i, f"http://x/{i}", payload, hashlib.sha256(payload).hexdigest(), None)
        parts.append(gzip.compress(record, 1) if compressed else record)
    path = tmp_path / ("a.warc.gz" if compressed else "a.warc")
    starts = [sum(map(len, parts[:i])) for i in range(n + 1)]
    return path, parts, starts


def read(path, data):
    path.write_bytes(data)
    rows = list(warc.salvage(str(path)))
    ids = [r["page_id"] for r in rows if r["record_type"] != "gap"]
    gaps = [(r["start"], r["stop"]) for r in rows if r["record_type"] == "gap"]
    covered = sorted((r["start"], r["stop"]) for r in rows)
    assert covered[0][0] == 0 and covered[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(covered, covered[1:]))  # every byte is in a record or a gap
    return ids, gaps


@pytest.mark.parametrize("compressed", [True, False])
def test_damage(tmp_path, compressed):
    path, parts, at = archive(tmp_path, compressed)
    whole = b"".join(parts)
    assert read(path, whole) == (list(range(30)), [])
    middle = (at[7] + at[8]) // 2
    flipped = whole[:middle] + bytes(b ^ 0x55 for b in whole[middle:middle + 4]) + whole[middle + 4:]
    assert read(path, flipped) == ([i for i in range(30) if i != 7], [(at[7], at[8])])
    assert read(path, whole[:at[29] + 40]) == (list(range(29)), [(at[29], at[29] + 40)])
    assert read(path, whole[at[3] + 9:]) == (list(range(4, 30)), [(0, at[4] - at[3] - 9)])
    junk = bytes(range(256)) * 20
    assert read(path, junk + whole[:at[5]] + junk + whole[at[5]:]) == (list(range(30)), [(0, len(junk)), (len(junk) + at[5], 2 * len(junk) + at[5])])
    assert read(path, whole[:at[10] + 30] + whole[at[12]:])[0] == [i for i in range(30) if i not in (10, 11)]
    assert read(path, b"nothing at all") == ([], [(0, 14)])


def test_reasons_and_wrong_length(tmp_path):
    path, parts, at = archive(tmp_path, False, 4)
    longer = parts[1].replace(b"Content-Length: ", b"Content-Length: 1", 2)
    path.write_bytes(parts[0] + longer + b"".join(parts[2:]))
    rows = list(warc.salvage(str(path)))
    assert [r["page_id"] for r in rows if r["record_type"] != "gap"] == [0, 2, 3]
    assert [r["reason"] for r in rows if r["record_type"] == "gap"][0] in ("no record end at the content length", "truncated record")


@pytest.mark.parametrize("damage", ["digest", "crc", "truncated", "version"])
def test_member_of_several_records(tmp_path, damage):
    path, parts, at = archive(tmp_path, False, 400)
    content = b"".join(parts)
    if damage == "digest":
        content = content[:at[150] - 50] + b"#" + content[at[150] - 49:]
    if damage == "version":
        content = content[:at[149]] + b"XXXX" + content[at[149] + 4:]
    data = gzip.compress(content, 1)
    lost, reason = {149}, {"digest": "block digest differs", "version": "no version line"}.get(damage)
    if damage == "crc":
        data, lost, reason = data[:-8] + b"\0\0\0\0" + data[-4:], set(), "damaged member"
    if damage == "truncated":
        data, reason = data[:len(data) // 2], "truncated member"
    tail = gzip.compress(parts[0], 1)
    path.write_bytes(data if damage == "truncated" else data + tail)
    rows = list(warc.salvage(str(path)))
    ids = [r["page_id"] for r in rows if r["record_type"] != "gap"]
    gaps = [r for r in rows if r["record_type"] == "gap"]
    assert len(gaps) == 1 and gaps[0]["reason"].startswith(reason)
    if damage == "truncated":
        assert 150 < len(ids) < 250 and ids == list(range(len(ids)))
    else:
        assert ids == [i for i in range(400) if i not in lost] + [0]
        assert all((r["start"], r["stop"]) == (0, len(data)) for r in rows[:-1])


def test_bounded_member_and_long_header(tmp_path):
    payload = b"z" * 1000
    record = warc.record_bytes(1, "u" * (6 << 20), payload, hashlib.sha256(payload).hexdigest(), None)
    for compressed in (False, True):
        path = tmp_path / f"long{compressed}"
        path.write_bytes(gzip.compress(record, 1) if compressed else record)
        assert [(r["page_id"], r["record_type"]) for r in warc.salvage(str(path))] == [(1, "response")]
    path.write_bytes(gzip.compress(b"".join(warc.record_bytes(i, "u", payload, hashlib.sha256(payload).hexdigest(), None) for i in range(20_000)), 1))
    file = warc.Blocks(str(path))
    content = warc._Content(file, 0)
    read, held = content.read, []

    def watched(at, n):
        out = read(at, n)
        held.append(len(content.held))
        return out

    content.read = watched
    assert len(warc._member(content)) == 20_000 and max(held) < 1 << 20
    file.close()
