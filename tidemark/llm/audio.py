"""Telephony audio: companded and ADPCM payloads in WAV containers, expanded and resampled.

store_payloads() puts bytes into a media column as mu-law, A-law or IMA ADPCM samples; nothing is encoded, so the
payload comes back bit for bit. read_media() opens stored media, expands mu-law and A-law through lookup tables,
decodes ADPCM one sample position at a time across all blocks of a batch, and resamples from 8 to 16 kHz.

Null text counts as empty: its payload is 64 zero bytes. The codec follows from the payload, so equal texts give
equal media and equal features. Media that aren't a container of the kinds above raise ValueError.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import BATCH_BYTES, cells, in_batches, map_arrow

BLOCK = 64
RATE = 8000
#: WAVE format tags.
A_LAW, MU_LAW, IMA_ADPCM = 6, 7, 17
_NAMES = {A_LAW: "alaw", MU_LAW: "mulaw", IMA_ADPCM: "adpcm"}
#: A block of ADPCM starts with a sample, a step index and a spare byte; each other byte holds two samples.
_BLOCK_SAMPLES = 1 + 2 * (BLOCK - 4)

# Fixed values of the IMA ADPCM format.
_STEPS = np.array(
    [
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97,
        107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796,
        876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428,
        4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350,
        22385, 24623, 27086, 29794, 32767,
    ],
    np.int32,
)
_INDEX_MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8], np.int32)
# Half-band interpolation filter between two samples, in 1/32768.
_HALFWAY = np.array([-156, 1109, -4606, 20037, 20037, -4606, 1109, -156], np.int64)


@lru_cache(maxsize=1)
def mu_law_table() -> np.ndarray:
    code = ~np.arange(256) & 0xFF
    size = (((code & 0x0F) << 3) + 0x84 << ((code & 0x70) >> 4)) - 0x84
    return np.where(code & 0x80, -size, size).astype(np.int16)


@lru_cache(maxsize=1)
def a_law_table() -> np.ndarray:
    code = np.arange(256) ^ 0x55
    segment = (code & 0x70) >> 4
    size = ((code & 0x0F) << 4) + 8
    size = np.where(segment == 0, size, size + 0x100 << np.maximum(segment - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


@lru_cache(maxsize=1)
def _adpcm_tables() -> tuple[np.ndarray, np.ndarray]:
    """What a nibble adds to the predictor, and the next step index, for each step index and nibble."""
    step, nibble = _STEPS[:, None], np.arange(16)[None, :]
    size = (step >> 3) + step * (nibble >> 2 & 1) + (step >> 1) * (nibble >> 1 & 1) + (step >> 2) * (nibble & 1)
    change = np.where(nibble & 8, -size, size)
    index = np.clip(np.arange(len(_STEPS))[:, None] + _INDEX_MOVES[nibble & 7], 0, len(_STEPS) - 1)
    return change.astype(np.int32).ravel(), (index * 16).astype(np.int32).ravel()


def decode_adpcm(payload: np.ndarray) -> np.ndarray:
    """Samples of mono IMA ADPCM blocks, a row for each block; bytes outside the index range are clamped."""
    blocks = payload.reshape(-1, BLOCK)
    change, following = _adpcm_tables()
    nibbles = np.empty((2 * (BLOCK - 4), len(blocks)), np.uint8)
    nibbles[0::2] = (blocks[:, 4:] & 15).T
    nibbles[1::2] = (blocks[:, 4:] >> 4).T
    out = np.empty((_BLOCK_SAMPLES, len(blocks)), np.int16)
    sample = np.ascontiguousarray(blocks[:, :2]).view("<i2").ravel().astype(np.int32)
    row = np.minimum(blocks[:, 2], len(_STEPS) - 1).astype(np.int32) * 16
    out[0] = sample
    for k, nibble in enumerate(nibbles, 1):
        at = row + nibble
        sample = np.clip(sample + change[at], -32768, 32767)
        row = following[at]
        out[k] = sample
    return np.ascontiguousarray(out.T)


def resample_double(pcm: np.ndarray) -> np.ndarray:
    """Twice the sample rate: the samples themselves, and between each two a filtered one; the ends are repeated."""
    half = len(_HALFWAY) // 2
    padded = np.concatenate([np.repeat(pcm[:1], half - 1), pcm, np.repeat(pcm[-1:], half)]).astype(np.int32)
    between = np.zeros(len(pcm), np.int32)
    for k, weight in enumerate(_HALFWAY.tolist()):
        between += (padded[k : k + len(pcm)] * weight) >> 2
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2] = pcm
    out[1::2] = np.clip(between + (1 << 12) >> 13, -32768, 32767)
    return out


def pack(payload: bytes, codec: int) -> bytes:
    """A WAV file around the payload."""
    block, bits, extra = (BLOCK, 4, struct.pack("<HH", 2, _BLOCK_SAMPLES)) if codec == IMA_ADPCM else (1, 8, struct.pack("<H", 0))
    samples = len(payload) // BLOCK * _BLOCK_SAMPLES if codec == IMA_ADPCM else len(payload)
    rate = RATE * BLOCK // _BLOCK_SAMPLES if codec == IMA_ADPCM else RATE
    head = struct.pack("<HHIIHH", codec, 1, RATE, rate, block, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(head)) + head + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(payload)) + payload
    return b"RIFF" + struct.pack("<I", len(body)) + body


def unpack(media: bytes) -> tuple[int, bytes]:
    """The format tag and payload of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, codec = 12, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], int.from_bytes(media[at + 4 : at + 8], "little")
        if name == b"fmt ":
            codec = int.from_bytes(media[at + 8 : at + 10], "little")
        elif name == b"data":
            if codec not in _NAMES:
                raise ValueError(f"format tag {codec} isn't supported")
            return codec, media[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)
    raise ValueError("a WAV file without data")


_STORED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])


def _store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc_id, text in cells(batch, "doc_id", "text"):
                raw = (text or "").encode()
                payload = raw + bytes(-len(raw) % BLOCK if raw else BLOCK)
                yield doc_id, len(raw), pack(payload, (A_LAW, MU_LAW, IMA_ADPCM)[zlib.crc32(payload) % 3])

    return in_batches(rows(), _STORED)


def store_payloads(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and media: each text's UTF-8 bytes, padded with zeros to whole blocks of 64, as a WAV file."""
    return docs.selectExpr("cast(doc_id as bigint) doc_id", "text").transform(map_arrow, _store, "doc_id bigint, n_bytes bigint, media binary")


_READ = "doc_id bigint, n_bytes bigint, media binary, payload binary, feature string"
_READ_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("payload", pa.binary()), ("feature", pa.string())])


def _expanded(group: list[tuple[int, np.ndarray]]) -> list[np.ndarray]:
    """PCM for each payload; the ADPCM blocks of all of them are decoded together."""
    blocks = [payload for codec, payload in group if codec == IMA_ADPCM]
    decoded = decode_adpcm(np.concatenate(blocks)) if blocks else None
    out, at = [], 0
    for codec, payload in group:
        if codec == IMA_ADPCM:
            n = len(payload) // BLOCK
            out.append(decoded[at : at + n].ravel())
            at += n
        else:
            out.append((mu_law_table() if codec == MU_LAW else a_law_table())[payload])
    return out


def _feature(codec: int, pcm: np.ndarray, wide: np.ndarray) -> str:
    loud = float(np.sqrt(np.mean(np.square(pcm, dtype=np.float64))))
    crossings = int(np.count_nonzero(np.signbit(pcm[1:]) != np.signbit(pcm[:-1])))
    return f"{_NAMES[codec]}:{len(pcm)}:{int(np.abs(pcm.astype(np.int32)).max())}:{loud:.2f}:{crossings}:{zlib.crc32(wide):08x}"


def _read(batches: Iterator[pa.RecordBatch], keep_pcm: bool) -> Iterator[pa.RecordBatch]:
    def finish(held):
        opened = [unpack(media) for _, _, media in held]
        group = [(codec, np.frombuffer(payload, np.uint8)) for codec, payload in opened]
        for (doc_id, n_bytes, media), (codec, payload), pcm in zip(held, opened, _expanded(group)):
            wide = resample_double(pcm)
            row = doc_id, n_bytes, media, payload, _feature(codec, pcm, wide)
            yield (*row, wide.astype("<i2").tobytes()) if keep_pcm else row

    def rows():
        held, size = [], 0
        for batch in batches:
            for row in cells(batch, "doc_id", "n_bytes", "media"):
                held.append(row)
                size += len(row[2])
                if size >= BATCH_BYTES // 4:
                    yield from finish(held)
                    held, size = [], 0
        yield from finish(held)

    return in_batches(rows(), _READ_ARROW.append(pa.field("pcm", pa.binary())) if keep_pcm else _READ_ARROW)


def read_media(stored: DataFrame, keep_pcm: bool = True) -> DataFrame:
    """What store_payloads() gave, with the payload, a feature string and, if kept, 16 kHz 16-bit PCM.

    feature: codec, samples, peak, root mean square, zero crossings and the CRC-32 of the resampled PCM.
    """
    return stored.select("doc_id", "n_bytes", "media").transform(map_arrow, partial(_read, keep_pcm=keep_pcm), _READ + ", pcm binary" * keep_pcm)
