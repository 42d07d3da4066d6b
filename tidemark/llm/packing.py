"""Packing of documents into training sequences, in order, by dynamic programming.

The ids of a partition's documents, each followed by an end id, form one stream. Cuts between sequences may fall
at ends of documents (free), at ends of sentences (a small penalty) and, where a sentence is long, inside it (a
larger one). The cuts minimise padding plus penalties. The transition of a boundary looks back over the boundaries
within one window; as the cost is a term of the earlier boundary plus one of the later, the best of them is kept
at the head of a monotone queue, so each boundary costs constant time.

A sequence shorter than the window is padded to it, unless its length is a power of two, from 2**least_power on.

The stream is solved in stretches of bounded length, the last sequence of each being carried over, so memory is
bounded by a stretch and the longest document. The last stretch of a partition is solved like the others, to its end,
so a partition costs less than a window of padding more than its cuts inside do, and has one sequence below
2**least_power tokens at most. Partitions are independent: nothing is shuffled, and a task that is run again gives the
same rows as long as its partition holds the same rows.

Null text counts as empty: its document is the end id alone. Documents keep the order of the input. A control string
of the tokenizer inside a text gives its id, as in the tokenizer's own library; with controls_as_text it is encoded like
any other text, so that no document can hold an id that steers a model.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import cells, in_batches, map_arrow
from tidemark.llm.pretokens import byte_letters, finder

WINDOW = 4096
_STRETCH = 128 * WINDOW
_LONGEST_KEPT = 64


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


class WordTokenizer:
    """Ids of a lower-casing word tokenizer; its pre-tokens are independent, so each is encoded once and remembered."""

    #: Pre-tokens as the tokenizer finds them after lower-casing: contractions, letters, single digits, other characters.
    _PIECES = r"'[sStTmMdD]|'[rRvV][eE]|'[lL][lL]|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"

    #: Letters whose lower case is longer or depends on their neighbours.
    _ODD = "\u0130\u03a3"

    def __init__(self, path: str, controls_as_text: bool = False, remembered: int = 250_000):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = controls_as_text
        self._controls = [] if controls_as_text else [token.content for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._find = finder(self._PIECES)
        self._letters = byte_letters()
        self._model = self._tokenizer.model
        self._pieces = _Kept(self._piece, remembered)
        ends = [k for token, k in self._tokenizer.get_vocab().items() if token.endswith("</w>") and token != "</w>" and set(token[:-4]) <= set(".!?")]
        self.is_sentence_end = np.zeros(self._tokenizer.get_vocab_size(), bool)
        self.is_sentence_end[ends] = True

    def _encode(self, text: str) -> bytes:
        return array("I", self._tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        lowered = piece.lower()
        letters = lowered if lowered.isascii() and lowered.isprintable() else "".join([self._letters[byte] for byte in lowered.encode()])
        return array("I", [token.id for token in self._model.tokenize(letters)]).tobytes()

    def encode(self, text: str) -> np.ndarray:
        # Where normal forms or case change the classes of characters, or control strings cut the text, the pre-tokens can't be told beforehand.
        if not unicodedata.is_normalized("NFC", text) or any(part in text for part in (*self._ODD, *self._controls)):
            return np.frombuffer(self._encode(text), np.uint32)
        return np.frombuffer(b"".join(map(self._pieces.__getitem__, self._find(text))), np.uint32)


@lru_cache(maxsize=2)
def _tokenizer(path: str, controls_as_text: bool) -> WordTokenizer:
    return WordTokenizer(path, controls_as_text)


def cut(positions: list[int], penalties: list[float], window: int = WINDOW, exact: dict[int, list[int]] | None = None) -> list[int]:
    """Indices of the boundaries at which to cut, from the first to the last boundary.

    positions: increasing, at most a window apart. The cost of a sequence is its padding and the penalty of its
    end; exact[j] lists earlier boundaries from which a sequence to j needs no padding.
    """
    exact = exact or {}
    came = [0] * len(positions)
    best = [0.0] * len(positions)
    #: best + position; the queue holds boundaries in order, with increasing keys.
    keys = [float(positions[0])] * len(positions)
    queue = deque([0])
    for j in range(1, len(positions)):
        here = positions[j]
        while positions[queue[0]] < here - window:
            queue.popleft()
        i = queue[0]
        cost = keys[i] + window - here
        if j in exact:
            for k in exact[j]:
                if best[k] < cost:
                    cost, i = best[k], k
        cost += penalties[j]
        came[j], best[j] = i, cost
        key = keys[j] = cost + here
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(j)
    cuts = [len(positions) - 1]
    while cuts[-1]:
        cuts.append(came[cuts[-1]])
    return cuts[::-1]


def boundaries(ids: np.ndarray, document_ends: np.ndarray, sentence_end: np.ndarray, window: int, sentence: float, inside: float, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, with penalties; stretches without any for more than a gap get extra ones."""
    marks = np.flatnonzero(sentence_end[ids]) + 1
    places = np.union1d(np.union1d(marks, document_ends), [0])
    penalty = np.where(np.isin(places, document_ends), 0.0, sentence)
    wide = np.flatnonzero(np.diff(places) > gap)
    if len(wide):
        extra = np.concatenate([np.arange(places[k] + gap, places[k + 1], gap) for k in wide])
        places, penalty = np.concatenate([places, extra]), np.concatenate([penalty, np.full(len(extra), inside)])
        order = np.argsort(places, kind="stable")
        places, penalty = places[order], penalty[order]
    return places, penalty


def _without_padding(places: np.ndarray, window: int, least_power: int) -> dict[int, list[int]]:
    exact: dict[int, list[int]] = {}
    for power in range(least_power, window.bit_length() - 1):
        wanted = places - (1 << power)
        at = np.searchsorted(places, wanted)
        for j in np.flatnonzero(places[np.minimum(at, len(places) - 1)] == wanted).tolist():
            exact.setdefault(j, []).append(int(at[j]))
    return exact


_OUT = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
_OUT_ARROW = pa.schema([(name, pa.int64()) for name in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


class _Packer:
    """Gathers documents, and gives rows of pieces once a stretch is full."""

    def __init__(self, first_id: int, sentence_end: np.ndarray, window: int, sentence: float, inside: float, gap: int, least_power: int, keep_ids: bool):
        self._next, self._sentence_end, self._window, self._least = first_id, sentence_end, window, least_power
        self._costs = sentence, inside, min(gap, window)
        self._keep_ids = keep_ids
        #: doc_id, ids, how many ids came before these, ids of the whole document
        self._held: list[tuple[int | None, np.ndarray, int, int]] = []
        self._size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        self._held.append((doc_id, ids, 0, len(ids)))
        self._size += len(ids)
        if self._size >= _STRETCH:
            yield from self._solve()

    def finish(self) -> Iterator[tuple]:
        if self._size:
            yield from self._solve(last=True)

    def _solve(self, last: bool = False) -> Iterator[tuple]:
        ids = np.concatenate([ids for _, ids, _, _ in self._held])
        ends = np.cumsum([len(ids) for _, ids, _, _ in self._held])
        places, penalty = boundaries(ids, ends, self._sentence_end, self._window, *self._costs)
        cuts = cut(places.tolist(), penalty.tolist(), self._window, _without_padding(places, self._window, self._least))
        yield from self._emit([int(places[k]) for k in (cuts if last else cuts[:-1])])

    def _emit(self, cuts: list[int]) -> Iterator[tuple]:
        """Rows for the sequences between cuts; what lies after the last cut stays."""
        begin, rest = 0, []
        for doc_id, ids, before, total in self._held:
            at = 0
            while at < len(ids):
                k = bisect_right(cuts, begin + at) - 1
                if k + 1 >= len(cuts):
                    rest.append((doc_id, ids[at:], before + at, total))
                    break
                stop = min(len(ids), cuts[k + 1] - begin)
                piece = ids[at:stop].astype("<u4").tobytes()
                row = doc_id, before + at, stop - at, zlib.crc32(piece), total, self._next + k, begin + at - cuts[k]
                yield (*row, piece) if self._keep_ids else row
                at = stop
            begin += len(ids)
        self._next += len(cuts) - 1
        self._held, self._size = rest, sum(len(ids) for _, ids, _, _ in rest)


def _packed(batches: Iterator[pa.RecordBatch], path: str, end_id: int, keep_ids: bool, controls_as_text: bool, **costs) -> Iterator[pa.RecordBatch]:
    tokenizer = _tokenizer(path, controls_as_text)
    packer = _Packer(TaskContext.get().partitionId() << 32, tokenizer.is_sentence_end, keep_ids=keep_ids, **costs)
    end = np.array([end_id], np.uint32)

    def rows():
        for batch in batches:
            for doc_id, text in cells(batch, "doc_id", "text"):
                yield from packer.add(doc_id, np.concatenate([tokenizer.encode(text or ""), end]))
        yield from packer.finish()

    return in_batches(rows(), _OUT_ARROW.append(pa.field("ids", pa.binary())) if keep_ids else _OUT_ARROW)


def pack_documents(
    docs: DataFrame, path: str, end_id: int = 2, window: int = WINDOW, sentence: float = 8.0, inside: float = 64.0, gap: int = 256, least_power: int = 9, keep_ids: bool = True, controls_as_text: bool = False
) -> DataFrame:
    """A row for each piece of a document: where it starts there, its length, CRC-32 and place in a sequence.

    sequence_id is the partition's number times 2**32 plus a count. With keep_ids the piece's ids follow, as
    little-endian unsigned 32-bit integers. sentence and inside are penalties in tokens, gap the longest stretch
    without a boundary.
    """
    pieces = partial(_packed, path=path, end_id=end_id, keep_ids=keep_ids, controls_as_text=controls_as_text, window=window, sentence=sentence, inside=inside, gap=gap, least_power=least_power)
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").transform(map_arrow, pieces, _OUT + ", ids binary" * keep_ids)
