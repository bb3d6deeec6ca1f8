"""Word spans and rolling hashes of UTF-8 bytes, vectorised; small helpers for code inside tasks.

Hashes here only choose candidates, buckets or feature slots; whoever needs equality compares the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

WHITESPACE = b"\t\n\x0b\x0c\r "
SLICE_BYTES = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[list(WHITESPACE)] = False

#: ASCII letters and digits, and every byte of a non-ASCII character
WORDLIKE = np.zeros(256, dtype=bool)
WORDLIKE[0x30:0x3A] = WORDLIKE[0x41:0x5B] = WORDLIKE[0x61:0x7B] = True
WORDLIKE[0x80:] = True

_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n; kept, as slices have about the same length."""
    if "up" not in _powers or len(_powers["up"]) < n:
        for key, base in (("up", BASE), ("down", BASE_INVERSE)):
            steps = np.full(max(n, SLICE_BYTES + 1024), base, dtype=np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def slices(data: bytes, limit: int = SLICE_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of pieces cut after white space, so that no word is cut.

    A piece exceeds ``limit`` only by the word that crosses it.
    """
    start, n = 0, len(data)
    while start < n:
        end = min(start + limit, n)
        while end < n and data[end - 1] not in WHITESPACE:
            end += 1
        yield start, data[start:end]
        start = end


def spans(data: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are ``member``."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = member[data]
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], dtype=np.uint64, out=sums[1:])
    return sums


def hashes_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit value for each span; equal bytes give equal values wherever they stand."""
    _, down = _power_table(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    return hashes_between(prefix_sums(data), starts, ends)


def word_table(data: bytes, member: np.ndarray = NOT_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words of a text of any length, in pieces of bounded size."""
    parts = []
    for offset, piece in slices(data):
        raw = np.frombuffer(piece, dtype=np.uint8)
        starts, ends = spans(raw, member)
        parts.append((starts + offset, ends + offset, span_hashes(raw, starts, ends)))
    if not parts:
        none = np.empty(0, dtype=np.int64)
        return none, none, np.empty(0, dtype=np.uint64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive words, from the words' hashes."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            total = total * np.uint64(0xD6E8FEB86659FD93) + words[i : i + count]
    return mixed(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` consecutive values, in about log2(width) passes."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values
