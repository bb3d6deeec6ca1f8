"""Binary files in the shared folder, written and read inside tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark import TaskContext


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder or file: local, HDFS or an object store."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    return fs.FileSystem.from_uri(uri)


def attempt_name(stem: str, suffix: str) -> str:
    """A name that no other attempt at the same task uses; only names in the committed manifest are read."""
    context = TaskContext.get()
    return f"{stem}-{context.partitionId() if context else 0:06d}-{uuid.uuid4().hex[:12]}{suffix}"


class Blocks:
    """Bytes of a file by offset, through one block held in memory."""

    def __init__(self, uri: str, block: int = 1 << 20):
        system, path = filesystem(uri)
        self.file = system.open_input_file(path)
        self.size, self.block = self.file.size(), block
        self.start, self.held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        """Up to ``n`` bytes from ``at``; fewer only at the end of the file."""
        n = min(n, self.size - at)
        if n <= 0:
            return b""
        if at < self.start or at + n > self.start + len(self.held):
            self.start, self.held = at, self.file.read_at(min(max(n, self.block), self.size - at), at)
        return self.held[at - self.start: at - self.start + n]

    def find(self, what: bytes, at: int) -> int:
        """First place of ``what`` from ``at``, or -1."""
        while at < self.size:
            piece = self.read(at, self.block)
            k = piece.find(what)
            if k >= 0:
                return at + k
            if at + len(piece) >= self.size:
                return -1
            at += len(piece) - len(what) + 1
        return -1

    def close(self) -> None:
        self.file.close()
