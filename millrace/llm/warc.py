"""WARC archives: pages written as records, and a reader that salvages what damaged files still hold."""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.files import Blocks, attempt_name, filesystem
from millrace.llm.staging import spread, stored
from millrace.session import scratch_path

MIN_REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
VERSION = b"WARC/1."
GZIP = b"\x1f\x8b\x08"
#: fixed by the format: a revisit whose payload equals that of the record it refers to
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"

RECORD = ("path string, start long, stop long, record_type string, record_id string, page_id long, uri string, "
          "payload_digest string, payload_bytes long, refers_to long, reason string")


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'{page_id} {digest}'.encode()).digest())}>"


def _header_text(value: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """One record; with ``refers_to`` a revisit, which has the HTTP header of the payload but not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {_record_id(page_id, digest)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_header_text(url) if url else 'urn:unknown'}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {_record_id(refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES,
                   compressed: bool = True, level: int = 1) -> DataFrame:
    """Writes one record for each row of ``pages`` (page_id, url, html); returns the manifest (path, records).

    Records are gzip members of their own, or plain. Of rows whose payload has the same SHA-256 and at least
    ``min_revisit_bytes`` bytes, those with the smallest page_id are responses and the others revisits of it; a
    null page_id comes last, and rows that repeat the smallest page_id are all responses. Null html is an empty payload.
    Equal payloads are counted by digest before the shuffle, and only digests that occur twice are joined back, so a
    page copied to a third of the rows is one row of the smaller side. Files are named after the attempt that wrote
    them, so what a lost task has left is never read.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = (
        rows.where(F.octet_length("payload") >= min_revisit_bytes)
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    rows = rows.join(firsts, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("first")
    filesystem(folder)[0].create_dir(filesystem(folder)[1], recursive=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stream, path, n, size = None, None, 0, 0
        for batch in batches:
            ids, refers = (batch[c].astype("Int64").astype(object) for c in ("page_id", "refers_to"))
            for page_id, url, payload, digest, to in zip(ids, batch["url"], batch["payload"], batch["digest"], refers):
                if stream is None:
                    path = f"{folder}/{attempt_name('pages', '.warc.gz' if compressed else '.warc')}"
                    system, place = filesystem(path)
                    stream, n, size = system.open_output_stream(place, compression=None), 0, 0
                data = record_bytes(None if page_id is pd.NA else int(page_id), url, payload, digest, None if to is pd.NA else int(to))
                stream.write(_gzip_member(data, level) if compressed else data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    stream.close()
                    stream = None
                    yield pd.DataFrame([(path, n)], columns=["path", "records"])
        if stream is not None:
            stream.close()
            yield pd.DataFrame([(path, n)], columns=["path", "records"])

    out = rows.select("page_id", "url", "payload", "digest", "refers_to").mapInPandas(run, "path string, records long")
    return stored(out, "warc-manifest")


class _Bad(Exception):
    """A failed check; ``stop``: where the record ends, if its frame is sound."""

    def __init__(self, reason: str, stop: int | None = None):
        super().__init__(reason)
        self.reason, self.stop = reason, stop


def _parse(read, at: int, size: int | None) -> tuple[dict, bytes, int]:
    """(headers, block, end) of the record at ``at``; ``read(at, n)`` gives bytes of a file or of a gzip member, whose ``size`` is not known."""
    head, want, seen = read(at, 4096), 4096, 0
    if not head.startswith(VERSION):
        raise _Bad("no version line")
    while (end := head.find(b"\r\n\r\n", seen)) < 0:
        if len(head) < want:
            raise _Bad("header without end")
        seen = max(len(head) - 3, 0)
        want *= 4
        head = read(at, want)
    lines = head[:end].decode("utf-8", "replace").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise _Bad("malformed header line")
        headers[name.strip().lower()] = value.strip()
    length = headers.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise _Bad("no content length")
    start, length = at + end + 4, int(length)
    stop = start + length + 4
    if size is not None and stop > size:
        raise _Bad("truncated record")
    block = read(start, length)
    if len(block) < length:
        raise _Bad("truncated record")
    if read(start + length, 4) != b"\r\n\r\n":
        raise _Bad("no record end at the content length")
    kind, _, digest = headers.get("warc-block-digest", "").partition(":")
    if kind.lower() == "sha256" and hashlib.sha256(block).hexdigest() != digest.lower():
        raise _Bad("block digest differs", stop)
    return headers, block, stop


def _described(headers: dict, block: bytes) -> dict:
    kind = headers.get("warc-type")
    payload, stated = block, None
    if headers.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        for line in http.split(b"\r\n"):
            if line.lower().startswith(b"content-length:") and line[15:].strip().isdigit():
                stated = int(line[15:])
    digest = headers.get("warc-payload-digest", "").partition(":")[2]
    if kind != "revisit":
        own = hashlib.sha256(payload).hexdigest()
        if headers.get("warc-payload-digest", "").lower().startswith("sha256:") and own != digest.lower():
            raise _Bad("payload digest differs")
        digest, stated = own, len(payload)
    number = lambda name: int(headers[name]) if headers.get(name, "").lstrip("-").isdigit() else None
    return {"record_type": kind, "record_id": headers.get("warc-record-id"), "page_id": number("x-page-id"), "uri": headers.get("warc-target-uri"),
            "payload_digest": digest, "payload_bytes": stated, "refers_to": number("x-refers-to-page-id")}


class _Content:
    """Content of the gzip member at ``at`` by offset, forwards: holds what ``read`` and ``find`` look at, not the member."""

    def __init__(self, file: Blocks, at: int, piece: int = 1 << 16):
        self.file, self.place, self.piece = file, at, piece
        self.opener, self.start, self.held = zlib.decompressobj(31), 0, bytearray()
        self.fault: str | None = None  # why the content ends early
        self.stop: int | None = None  # end of the member in the file, known at its end

    def _more(self) -> bool:
        """Decompresses one piece; False at the end of what can be had. The CRC is checked by the decompressor."""
        if self.fault or self.stop is not None:
            return False
        packed = self.opener.unconsumed_tail
        if not packed:
            packed = self.file.read(self.place, self.piece)
            self.place += len(packed)
        if not packed:
            self.fault = "truncated member"
            return False
        before = self.opener.copy()
        try:
            self.held += self.opener.decompress(packed, self.piece)
        except zlib.error as e:
            self.fault = f"damaged member: {e}"
            for k in range(len(packed)):  # what comes before the damage, byte by byte
                try:
                    self.held += before.decompress(packed[k:k + 1])
                except zlib.error:
                    break
            return False
        if self.opener.eof:
            self.stop = self.place - len(self.opener.unused_data)
        return True

    def drop(self, at: int) -> None:
        """Nothing before ``at`` is read again."""
        gone = min(max(at - self.start, 0), len(self.held))
        del self.held[:gone]
        self.start += gone

    def read(self, at: int, n: int) -> bytes:
        while self.start + len(self.held) < at + n and self._more():
            pass
        return bytes(self.held[at - self.start: at - self.start + n])

    def find(self, what: bytes, at: int) -> int:
        """First place of ``what`` from ``at``, or -1. Drops what was searched."""
        while True:
            self.drop(at)
            k = self.held.find(what, at - self.start)
            if k >= 0:
                return self.start + k
            at = max(at, self.start + len(self.held) - len(what) + 1)
            if not self._more():
                return -1


def _member(content: _Content) -> list[dict]:
    """Records and gaps of a member, in order. Holds one record's bytes at a time, and what is told of each.

    In a member that breaks off or whose CRC differs only records with a SHA-256 of their block count, as nothing
    else vouches for the others.
    """
    out, at = [], 0

    def leave_out(start: int, stop: int, reason: str) -> None:
        if out and out[-1].get("record_type") == "gap":
            out[-1]["to"] = stop
        else:
            out.append({"record_type": "gap", "from": start, "to": stop, "reason": reason})

    while content.read(at, 1):
        start = at
        try:
            headers, block, at = _parse(content.read, at, None)
            record = {**_described(headers, block), "from": start, "to": at}
            out.append({**record, "sure": headers.get("warc-block-digest", "").lower().startswith("sha256:")})
        except _Bad as e:
            if at == start:
                found = e.stop if e.stop is not None else content.find(VERSION, start + 1)
                at = found if found >= 0 else content.start + len(content.held)
            leave_out(start, at, content.fault or e.reason)
        content.drop(at)
    if content.fault:
        told, out = out, []
        for x in told:
            if x.get("sure"):
                out.append(x)
            else:
                leave_out(x["from"], x["to"], x.get("reason") or content.fault)
        if not any(x.get("reason") == content.fault for x in out):
            out.append({"record_type": "gap", "from": at, "to": at, "reason": content.fault})
    for x in out:
        start, stop = x.pop("from"), x.pop("to")
        x.pop("sure", None)
        if x["record_type"] == "gap":
            x["reason"] += f" (bytes {start} to {stop} of the content)"
    return out


def _starts_member(file: Blocks, at: int) -> bool:
    try:
        return zlib.decompressobj(31).decompress(file.read(at, 512), len(VERSION)).startswith(VERSION)
    except zlib.error:
        return False


def _next_start(file: Blocks, at: int) -> int:
    """Next place from ``at`` where a member or a record may begin, or the end of the file."""
    member = at
    while (member := file.find(GZIP, member)) >= 0 and not _starts_member(file, member):
        member += 1
    return min((x for x in (member, file.find(VERSION, at)) if x >= 0), default=file.size)


def salvage(uri: str) -> Iterator[dict]:
    """Records of one file, in order, and a row of type ``gap`` with its reason for every range of bytes left out.

    A record counts if its version line, headers, content length, end and digests hold. After a failed check the
    next gzip member whose content begins with a version line, or the next version line, is tried, and so on; a record whose frame is sound but whose digest differs is left out alone. Adjacent gaps are one.
    Within a gzip member the search is the same over its content; its records and gaps all have the range of the member.
    """
    file = Blocks(uri)
    at, gap, reason = 0, None, None
    try:
        while at < file.size:
            try:
                if file.read(at, 3) == GZIP:
                    content = _Content(file, at)
                    found = _member(content)
                    if content.fault and not any(x["record_type"] != "gap" for x in found):
                        raise _Bad(content.fault)
                    stop = content.stop if content.stop is not None else _next_start(file, at + 1)
                    if all(x["record_type"] == "gap" for x in found):
                        raise _Bad(found[0]["reason"] if found else "empty member", stop)
                else:
                    headers, block, stop = _parse(file.read, at, file.size)
                    found = [_described(headers, block)]
            except _Bad as e:
                if gap is None:
                    gap, reason = at, e.reason
                at = e.stop if e.stop is not None else _next_start(file, at + 1)
                continue
            if gap is not None:
                yield {"path": uri, "start": gap, "stop": at, "record_type": "gap", "reason": reason}
                gap = None
            for record in found:
                yield {"path": uri, "start": at, "stop": stop, **record}
            at = stop
        if gap is not None:
            yield {"path": uri, "start": gap, "stop": file.size, "record_type": "gap", "reason": reason}
    finally:
        file.close()


def read_archives(files: DataFrame) -> DataFrame:
    """Rows of ``RECORD`` for every record and every gap of the files named in ``files`` (path).

    A file is read from its start in pieces of bounded size, one record in memory at a time; files are the unit of
    parallel work. Empty files give no rows; a null path is ignored.
    """
    columns = [c.split()[0] for c in RECORD.split(", ")]
    numbers = ("start", "stop", "page_id", "payload_bytes", "refers_to")

    def frame(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame({
            c: pd.array([r.get(c) for r in rows], dtype="Int64") if c in numbers else pd.Series([r.get(c) for r in rows], dtype=object)
            for c in columns})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = []
        for batch in batches:
            for path in batch["path"]:
                for row in salvage(path):
                    rows.append(row)
                    if len(rows) >= 5000:
                        yield frame(rows)
                        rows = []
        if rows:
            yield frame(rows)

    files = files.where("path is not null").select("path")
    return spread(files, "path", pieces=files.count()).mapInPandas(run, RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and reads them back; one row for each record."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder))
