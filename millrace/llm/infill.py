"""Fill-in-the-middle examples: documents as piece tables whose pieces are cut, rearranged and put back."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1 << 20
#: sentinels, in the order in which they stand in the sentinel buffer
SENTINELS = b"<P><S><M>"
PREFIX, SUFFIX, MIDDLE = ((1, at, 3) for at in (0, 3, 6))
TEXT = 0
#: order of sentinels and of the parts cut from the text, by form
FORMS = {"psm": (PREFIX, "prefix", SUFFIX, "suffix", MIDDLE, "middle"), "spm": (SUFFIX, "suffix", PREFIX, "prefix", MIDDLE, "middle")}
PARTS = ("prefix", "middle", "suffix")

LETTER = np.zeros(256, dtype=bool)
LETTER[0x41:0x5B] = LETTER[0x61:0x7B] = True

Piece = tuple[int, int, int]


class PieceTable:
    """A text as (buffer, start, length) descriptors over buffers that are never changed or copied."""

    def __init__(self, buffers: Sequence[bytes], pieces: Sequence[Piece]):
        self.buffers, self.pieces = buffers, [p for p in pieces if p[2]]

    def cut(self, *places: int) -> list[PieceTable]:
        """The tables before, between and after the ascending byte ``places``; descriptors that lie across are split."""
        out, at = [[]], 0
        places = list(places)
        for buffer, start, length in self.pieces:
            while places and places[0] <= at + length:
                here = places.pop(0) - at
                out[-1].append((buffer, start, here))
                out.append([])
                buffer, start, length, at = buffer, start + here, length - here, at + here
            out[-1].append((buffer, start, length))
            at += length
        out += [[] for _ in places]
        return [PieceTable(self.buffers, pieces) for pieces in out]

    def arranged(self, parts: Sequence[Sequence[Piece]]) -> PieceTable:
        return PieceTable(self.buffers, [p for part in parts for p in part])

    def stream(self) -> Iterator[memoryview]:
        for buffer, start, length in self.pieces:
            yield memoryview(self.buffers[buffer])[start: start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.stream():
            digest.update(part)
        return digest.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.stream())


def _marks(data: bytes, at: int) -> tuple[np.ndarray, np.ndarray]:
    """For a block of the text: which bytes begin a character, and which begin a unit."""
    raw = np.frombuffer(data, dtype=np.uint8, count=min(BLOCK, len(data) - at), offset=at)
    begins = (raw & 0xC0) != 0x80
    letter = LETTER[raw]
    follows = np.empty(len(raw), dtype=bool)
    follows[0] = at > 0 and LETTER[data[at - 1]]
    follows[1:] = letter[:-1]
    return begins, begins & ~(letter & follows)


def unit_counts(data: bytes) -> list[int]:
    """Units (a run of ASCII letters, or one other character) that begin in each block of a text of any length."""
    return [int(np.count_nonzero(_marks(data, at)[1])) for at in range(0, len(data), BLOCK)]


def unit_place(data: bytes, counts: Sequence[int], k: int) -> int:
    """Byte at which unit ``k`` begins; the end of the text for the unit after the last."""
    for i, n in enumerate(counts):
        if k < n:
            return i * BLOCK + int(np.flatnonzero(_marks(data, i * BLOCK)[1])[k])
        k -= n
    return len(data)


def characters(data: bytes, start: int, end: int) -> int:
    view = memoryview(data)
    return sum(int(np.count_nonzero((np.frombuffer(view[at: min(at + BLOCK, end)], dtype=np.uint8) & 0xC0) != 0x80))
               for at in range(start, end, BLOCK))


def draws(doc_id: int | None) -> list[int]:
    seed = "" if doc_id is None else str(doc_id)
    hexa = hashlib.sha256(f"1:{seed}".encode()).hexdigest()
    return [int(hexa[i: i + 8], 16) for i in range(0, 32, 8)]


def transformed(doc_id: int | None, text: bytes, plain_percent: int, spm_percent: int) -> tuple[str, int, int | None, int | None, PieceTable]:
    """(form, units, characters of prefix and middle, piece table of the output)."""
    counts = unit_counts(text)
    n = sum(counts)
    whole = PieceTable((text, SENTINELS), [(TEXT, 0, len(text))])
    h1, h2, h3, h4 = draws(doc_id)
    if not text or h3 % 100 >= 100 - plain_percent or any(SENTINELS[s: s + k] in text for _, s, k in (PREFIX, SUFFIX, MIDDLE)):
        return "plain", n, None, None, whole
    first, second = (unit_place(text, counts, k) for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    parts = dict(zip(PARTS, (t.pieces for t in whole.cut(first, second))))
    form = "spm" if h4 % 100 < spm_percent else "psm"
    table = whole.arranged([parts[p] if isinstance(p, str) else [p] for p in FORMS[form]])
    return form, n, characters(text, 0, first), characters(text, first, second), table


def restored(output: bytes, form: str) -> PieceTable:
    """The text as a piece table over an output: its parts, found by the sentinels, in the inverse order."""
    whole = PieceTable((output,), [(0, 0, len(output))])
    if form == "plain":
        return whole
    order = FORMS[form]
    places, names = [], []
    for sentinel, name in zip(order[::2], order[1::2]):
        _, start, length = sentinel
        at = output.index(SENTINELS[start: start + length], places[-1] if places else 0)
        places += [at, at + length]
        names.append(name)
    after = whole.cut(*places)[2::2]  # what follows each sentinel, up to the next
    found = {name: table.pieces for name, table in zip(names, after)}
    return whole.arranged([found[name] for name in PARTS])


PIECE_TYPE = pa.list_(pa.struct([("buffer", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]))
#: name, Spark type and Arrow type of the columns
COLUMNS = (
    ("doc_id", "long", pa.int64()), ("n", "long", pa.int64()), ("form", "string", pa.string()),
    ("prefix_chars", "long", pa.int64()), ("middle_chars", "long", pa.int64()),
    ("output_sha256", "string", pa.string()), ("restored_sha256", "string", pa.string()),
    ("pieces", "array<struct<buffer: int, start: long, length: long>>", PIECE_TYPE), ("output", "string", pa.binary()),
)


def fill_in_middle(docs: DataFrame, plain_percent: int = 10, spm_percent: int = 20, outputs: bool = True) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256, pieces[, output]) for each row.

    ``pieces`` are the output's descriptors (buffer 0 is the text, 1 the sentinels, bytes); ``output`` is its text, if
    asked for. Hashes stream the descriptors; the restored text is read from the output and the form alone.

    Null and empty texts are plain, with n 0 and the hash of no bytes. A null id draws as the text ``1:``. Equal ids
    draw alike; repeated rows give repeated rows; rows do not depend on each other, so there are no ties. Texts are
    searched in blocks, so a very long one costs its own bytes and its output's. Other columns are ignored, whatever their
    names; an empty table gives no rows.
    """
    columns = COLUMNS if outputs else COLUMNS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py() or b""
                form, n, prefix, middle, table = transformed(doc_id, data, plain_percent, spm_percent)
                output = table.bytes()
                pieces = [{"buffer": b, "start": s, "length": k} for b, s, k in table.pieces]
                rows.append((doc_id, n, form, prefix, middle, table.sha256(), restored(output, form).sha256(), pieces, output if outputs else None))
            arrays = [pa.array([r[i] for r in rows], type=kind) for i, (_, _, kind) in enumerate(columns)]
            yield pa.RecordBatch.from_arrays(
                [a.cast(pa.string(), safe=False) if pa.types.is_binary(a.type) else a for a in arrays], names=[c for c, _, _ in columns])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind, _ in columns))
