"""Byte-level BPE with a hierarchical-bitmap rank queue.

A pre-token's bytes form a linked list. Each adjacent pair whose joined bytes are in the vocabulary waits in the
bucket of its merge rank, by its left position. A hierarchy of bitmaps tells which buckets hold anything, so the
lowest rank is found by a find-first-set step on each level, whatever the length of the pre-token. Entries whose pair has
changed meanwhile are skipped when they come up. Within a rank the leftmost position goes first, as in the
published tokenizer.

Pre-tokens repeat, so a worker remembers the ids of those it has seen, up to a bounded number.

Null text counts as empty and gives no ids. Ids travel as little-endian unsigned 32-bit integers in a binary column.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import cells, in_batches, map_arrow
from tidemark.llm.pretokens import finder

_LONGEST_KEPT = 64


class RankQueue:
    """Positions in buckets by rank; pop() gives the leftmost position of the lowest rank.

    A word of 64 bits tells which of 64 neighbouring ranks have positions, the summary which words aren't zero.
    """

    __slots__ = ("_buckets", "_summary", "_words")

    def __init__(self) -> None:
        self._buckets: dict[int, list[int]] = {}
        self._words: dict[int, int] = {}
        self._summary = 0

    def __bool__(self) -> bool:
        return self._summary != 0

    def push(self, rank: int, position: int) -> None:
        if (bucket := self._buckets.get(rank)) is not None:
            heappush(bucket, position)
            return
        self._buckets[rank] = [position]
        word = rank >> 6
        if bits := self._words.get(word, 0):
            self._words[word] = bits | 1 << (rank & 63)
        else:
            self._words[word] = 1 << (rank & 63)
            self._summary |= 1 << word

    def pop(self) -> tuple[int, int]:
        summary = self._summary
        word = (summary & -summary).bit_length() - 1
        bits = self._words[word]
        bit = bits & -bits
        rank = (word << 6) + bit.bit_length() - 1
        bucket = self._buckets[rank]
        if len(bucket) > 1:
            return rank, heappop(bucket)
        del self._buckets[rank]
        self._words[word] = bits = bits ^ bit
        if not bits:
            self._summary = summary ^ 1 << word
        return rank, bucket[0]


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    following = list(range(1, n + 1))
    preceding = list(range(-1, n - 1))
    pair = [ranks.get(piece[i : i + 2], -1) for i in range(n)]
    pair[-1] = -1
    queue = RankQueue()
    push, pop, rank_of = queue.push, queue.pop, ranks.get
    for i, rank in enumerate(pair):
        if rank >= 0:
            push(rank, i)
    while queue._summary:
        rank, i = pop()
        if pair[i] != rank:
            continue
        gone = following[i]
        following[i] = after = following[gone]
        pair[gone] = pair[i] = -1
        if after < n:
            preceding[after] = i
            if (rank := rank_of(piece[i : following[after]], -1)) >= 0:
                pair[i] = rank
                push(rank, i)
        if (before := preceding[i]) >= 0:
            pair[before] = rank = rank_of(piece[before:after], -1)
            if rank >= 0:
                push(rank, before)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : following[i]]])
        i = following[i]
    return ids


class _Kept(dict):
    """A bounded memory of what make() gave for a text."""

    def __init__(self, make, limit: int):
        super().__init__()
        self._make, self._limit = make, limit

    def __missing__(self, key: str) -> bytes:
        value = self._make(key)
        if len(key) <= _LONGEST_KEPT:
            if len(self) >= self._limit:
                self.clear()
            self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder for a file of base64 tokens and ranks."""

    def __init__(self, path: str, pattern: str, remembered: int = 600_000):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self._find = finder(pattern)
        self._pieces = _Kept(self._piece, remembered)

    def _piece(self, piece: str) -> bytes:
        return array("I", merge(piece.encode("utf-8", "replace"), self.ranks)).tobytes()

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, self._find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def _coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


_OUT = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.binary())])


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    coder = _coder(path, pattern)

    def rows():
        for batch in batches:
            for doc_id, text in cells(batch, "doc_id", "text"):
                ids = coder.encode(text or "")
                yield doc_id, ids, coder.decode(ids)

    return in_batches(rows(), _OUT)


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the bytes they decode to, for each row of docs; other columns are ignored.

    path: a rank file that every executor can open (it comes with an installed package). Rows are independent, so
    nothing is shuffled and a lost task is simply run again.
    """
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").transform(
        map_arrow,
        partial(_encoded, path=path, pattern=pattern), "doc_id bigint, ids binary, decoded binary"
    )
