"""Token ids of texts, from a public vocabulary file whose path is a parameter."""

from __future__ import annotations

import base64

import numpy as np
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import SparkSession

from millrace.llm.staging import shipped

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value of the vocabulary: how it divides a text before merging bytes
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PIECE_CHARS = 1 << 19
#: a space between letters: no piece of the pattern lies across
CUT = regex.compile(r"(?<=\p{L}) (?=\p{L})")


class Tokenizer:
    """A rank file's vocabulary, opened once in each worker. The first id it leaves free marks the end of a document."""

    def __init__(self, ranks: bytes, pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern
        self.end = max(int(line.split()[1]) for line in ranks.splitlines() if line) + 1
        self.dtype = "<u2" if self.end < 1 << 16 else "<u4"
        self.width = np.dtype(self.dtype).itemsize
        self._library = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_library": None}

    def ids(self, text: str) -> list[int]:
        if self._library is None:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, self.ranks.splitlines())}
            self._library = tiktoken.Encoding("own", pat_str=self.pattern, mergeable_ranks=table, special_tokens={})
        return self._library.encode_ordinary(text)

    def encode(self, text: str | None) -> bytes:
        """Ids of one text as little-endian integers; none for a null or empty text. A long text goes in parts."""
        text, out, at = text or "", [], 0
        while at < len(text):
            cut = CUT.search(text, at + PIECE_CHARS) if len(text) - at > PIECE_CHARS else None
            stop = cut.start() if cut else len(text)
            out.append(np.array(self.ids(text[at:stop]), dtype=self.dtype).tobytes())
            at = stop
        return b"".join(out)


def shared_tokenizer(spark: SparkSession, vocabulary: str = VOCABULARY) -> tuple[Tokenizer, Broadcast]:
    """The vocabulary, and its copy for the tasks: about a megabyte, whatever the input."""
    with open(vocabulary, "rb") as f:
        tokenizer = Tokenizer(f.read())
    return tokenizer, shipped(spark, tokenizer)
