"""Telephony audio in media columns.

Bytes are stored as the samples of a WAV file in one of three telephone codings: mu-law and A-law
(one byte a sample) or IMA ADPCM (blocks of 64 bytes).  The container keeps every byte.  Decoding expands
mu-law and A-law through tables of 256 values made from their definitions, and ADPCM sample
by sample for all blocks of a batch at once; the PCM is resampled by linear interpolation.

Defined cases: null text is empty and gives one block of zero bytes; equal texts give equal values, since the coding is chosen from
the payload; repeated rows and null doc_id are stored like any others; an empty table gives an empty result; other columns are ignored.
PCM is four to eight times its text: beyond WHOLE bytes it is no longer a column of one row (null there), while its features stay; ``pcm_pieces``
gives the PCM of every file in rows of bounded size.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contigra.llm.common import column_bytes, slices, write_shared

BLOCK = 64
PIECE = 1 << 19  # a multiple of BLOCK
WHOLE = 1 << 30
RATE, TARGET = 8000, 16000
#: WAV format tags (fixed values).
TAGS = {"alaw": 6, "mulaw": 7, "adpcm": 17}
CODECS = ("mulaw", "alaw", "adpcm")
#: IMA ADPCM step sizes and index steps (fixed values).
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066,
    2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
])
INDEX = np.array([-1, -1, -1, -1, 2, 4, 6, 8])


def mulaw_table() -> np.ndarray:
    """The 16-bit value of each mu-law byte: sign, 3 bits of segment, 4 of step, all inverted, bias 132."""
    b = ~np.arange(256) & 255
    size = ((((b & 15) << 3) + 132) << ((b >> 4) & 7)) - 132
    return np.where(b & 128, -size, size).astype(np.int16)


def alaw_table() -> np.ndarray:
    """The 16-bit value of each A-law byte: even bits inverted; segment 0 is linear."""
    b = np.arange(256) ^ 0x55
    seg, step = (b >> 4) & 7, (b & 15) << 4
    size = np.where(seg == 0, step + 8, (step + 0x108) << np.maximum(seg - 1, 0))
    return np.where(b & 128, size, -size).astype(np.int16)


MULAW, ALAW = mulaw_table(), alaw_table()


def decode_adpcm(blocks: np.ndarray) -> np.ndarray:
    """(blocks, 121) samples of (blocks, 64) bytes: the header's first sample, then two a byte, low half first.

    All blocks advance together, one sample a step; a header's index beyond the table counts as the last.
    """
    value = blocks[:, 0].astype(np.int32) | (blocks[:, 1].astype(np.int32) << 8)
    value = np.where(value > 32767, value - 65536, value).astype(np.int32)
    index = np.minimum(blocks[:, 2], len(STEPS) - 1).astype(np.int32)
    out = np.empty((1 + 2 * (BLOCK - 4), len(blocks)), np.int16)
    out[0] = value
    data = np.ascontiguousarray(blocks[:, 4:].T)
    steps, change = STEPS.astype(np.int32), np.concatenate((INDEX, INDEX)).astype(np.int32)
    for k in range(2 * (BLOCK - 4)):
        code = (data[k // 2] >> (4 * (k % 2))) & 15
        step = steps[index]
        size = (step >> 3) + np.where(code & 4, step, 0) + np.where(code & 2, step >> 1, 0) + np.where(code & 1, step >> 2, 0)
        value = np.clip(np.where(code & 8, value - size, value + size), -32768, 32767)
        index = np.clip(index + change[code], 0, len(STEPS) - 1)
        out[k + 1] = value
    return np.ascontiguousarray(out.T)


class Resampler:
    """Linear interpolation to another rate, piece by piece; values between samples are rounded down."""

    def __init__(self, rate: int = RATE, target: int = TARGET):
        self.rate, self.target = rate, target
        self.first, self.done = 0, 0  # the source place of ``held``, and how many values were given
        self.held = np.empty(0, np.int16)

    def _upto(self, stop: int) -> np.ndarray:
        at = np.arange(self.done, stop, dtype=np.int64) * self.rate
        left = at // self.target - self.first
        right = np.minimum(left + 1, len(self.held) - 1)
        x = self.held.astype(np.int32)
        self.done = stop
        return (x[left] + (x[right] - x[left]) * (at % self.target) // self.target).astype(np.int16)

    def push(self, pcm: np.ndarray) -> np.ndarray:
        """The values whose both neighbours are known by now, and never more than all samples so far give in the end."""
        if self.rate == self.target:
            return pcm.astype(np.int16)
        self.held = np.concatenate((self.held, pcm.astype(np.int16)))
        known = self.first + len(self.held) - 1  # the last sample has no right neighbour yet
        out = self._upto(min(-(-known * self.target // self.rate), (known + 1) * self.target // self.rate)) if known > 0 else np.empty(0, np.int16)
        keep = max(0, min(len(self.held) - 1, self.done * self.rate // self.target - self.first))
        self.held, self.first = self.held[keep:], self.first + keep
        return out

    def end(self) -> np.ndarray:
        """The values up to the last sample, which stands for its own right neighbour."""
        total = self.first + len(self.held)
        if self.rate == self.target:
            return np.empty(0, np.int16)
        if total < 2:
            return self.held
        return self._upto(total * self.target // self.rate)


def resample(pcm: np.ndarray, rate: int = RATE, target: int = TARGET) -> np.ndarray:
    """``pcm`` at another rate; fewer than two samples stay as they are."""
    own = Resampler(rate, target)
    return np.concatenate((own.push(pcm), own.end()))


def payload(text: bytes | None) -> bytes:
    """The bytes with zeros appended up to a positive multiple of BLOCK."""
    text = text or b""
    return text + bytes(-len(text) % BLOCK if text else BLOCK)


def wav(data: bytes, codec: str, rate: int = RATE) -> bytes:
    """A WAV file whose data chunk is ``data``."""
    adpcm = codec == "adpcm"
    bits, align, samples = (4, BLOCK, len(data) // BLOCK * (2 * (BLOCK - 4) + 1)) if adpcm else (8, 1, len(data))
    per = 2 * (BLOCK - 4) + 1 if adpcm else 1
    extra = struct.pack("<HH", 2, per) if adpcm else struct.pack("<H", 0)
    head = struct.pack("<HHIIHH", TAGS[codec], 1, rate, rate * align // per, align, bits) + extra
    body = b"WAVEfmt " + struct.pack("<I", len(head)) + head + b"fact" + struct.pack("<II", 4, samples) + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wav(media: bytes) -> tuple[str, int, bytes]:
    """(coding, rate, data chunk) of a WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, tag, rate = 12, 0, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
        if name == b"data":
            return next(k for k, v in TAGS.items() if v == tag), rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def store(docs: DataFrame, codec: str | None = None) -> DataFrame:
    """doc_id, n_bytes, media: each text stored as a WAV file; without ``codec`` the payload's checksum chooses one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = column_bytes(batch, "text")
            data = [payload(t) for t in texts]
            media = [wav(d, codec or CODECS[zlib.crc32(d) % len(CODECS)]) for d in data]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t or b"") for t in texts], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


def pieces(codec: str, rate: int, data: bytes, size: int = PIECE) -> Iterator[np.ndarray]:
    """The resampled PCM of a file's data chunk, ``size`` bytes of it at a time; a piece may be empty."""
    raw, own = np.frombuffer(data, np.uint8), Resampler(rate)
    for a in range(0, len(raw), size):
        part = raw[a : a + size]
        yield own.push(decode_adpcm(part.reshape(-1, BLOCK)).ravel() if codec == "adpcm" else (MULAW if codec == "mulaw" else ALAW)[part])
    yield own.end()


class Features:
    """Coding, samples, mean square, peak, sign changes and checksum of the resampled PCM, piece by piece."""

    def __init__(self, codec: str):
        self.codec, self.n, self.power, self.peak, self.turns, self.crc, self.last = codec, 0, 0, 0, 0, 0, None

    def push(self, pcm: np.ndarray) -> None:
        if not len(pcm):
            return
        x = pcm.astype(np.int64)
        below = x < 0
        self.turns += int(np.count_nonzero(below[1:] != below[:-1])) + (self.last is not None and bool(below[0]) != self.last)
        self.n, self.power, self.peak, self.last = self.n + len(x), self.power + int((x * x).sum()), max(self.peak, int(np.abs(x).max())), bool(below[-1])
        self.crc = zlib.crc32(pcm.astype("<i2").tobytes(), self.crc)

    def __str__(self) -> str:
        return f"{self.codec};n={self.n};power={self.power // max(1, self.n)};peak={self.peak};turns={self.turns};crc={self.crc}"


def small_adpcm(read: list[tuple[str, int, bytes]]) -> dict[int, np.ndarray]:
    """The decoded samples of the ADPCM files of one piece at most, by number: many small files share each step."""
    own = [n for n, (codec, _, data) in enumerate(read) if codec == "adpcm" and len(data) <= PIECE]
    out: dict[int, np.ndarray] = {}
    while own:
        sizes = np.cumsum([len(read[n][2]) for n in own])
        now, own = own[: (k := max(1, int(np.searchsorted(sizes, PIECE, side="right"))))], own[k:]
        blocks = [np.frombuffer(read[n][2], np.uint8).reshape(-1, BLOCK) for n in now]
        pcm, at = decode_adpcm(np.concatenate(blocks)), 0
        for n, b in zip(now, blocks, strict=True):
            out[n] = pcm[at : at + len(b)].ravel()
            at += len(b)
    return out


def decode(media: list[bytes]) -> Iterator[tuple[str, bytes, Iterator[np.ndarray]]]:
    """(coding, stored bytes, pieces of resampled PCM) of each file."""
    read = [read_wav(m) for m in media]
    small = small_adpcm(read)
    for n, (codec, rate, data) in enumerate(read):
        if (pcm := small.pop(n, None)) is not None:
            yield codec, data, iter((resample(pcm, rate),))
        else:
            yield codec, data, pieces(codec, rate, data)


def decoded(stored: DataFrame, keep_pcm: bool = True, whole: int = WHOLE) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, and pcm (16-bit, TARGET Hz)."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string" + ", pcm binary" * keep_pcm

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media"):
            media = batch.column(2).to_pylist()
            rows = []
            for m, (codec, data, parts) in zip(media, decode(media), strict=True):
                features, held = Features(codec), []
                for pcm in parts:
                    features.push(pcm)
                    if keep_pcm and 2 * features.n <= whole:
                        held.append(pcm.astype("<i2"))
                    else:
                        held.clear()
                column = [np.concatenate(held).tobytes() if held else None] * keep_pcm
                rows.append((len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-BLOCK:]), len(m), hashlib.sha256(m).hexdigest(), str(features), *column))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()] + [pa.binary()] * keep_pcm
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names=[x.split()[0] for x in schema.split(", ")])

    return stored.mapInArrow(run, schema)


def pcm_pieces(stored: DataFrame) -> DataFrame:
    """doc_id, media_sha256, piece (from 0), start (samples before it), pcm: the resampled PCM of every file, in rows of some MB at most."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "media_sha256", "piece", "start", "pcm"]
        for batch in slices(batches, "media"):
            for doc_id, m in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                name, start = hashlib.sha256(m).hexdigest(), 0
                for k, pcm in enumerate(x for x in pieces(*read_wav(m)) if len(x)):
                    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((doc_id, name, k, start, pcm.astype("<i2").tobytes()), kinds, strict=True)], names=names)
                    start += len(pcm)

    return stored.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, media_sha256 string, piece int, start long, pcm binary")


def media_features(docs: DataFrame) -> DataFrame:
    """Store every text in the shared folder, read the files back and decode them; the resampled PCM stays as the last column."""
    return decoded(write_shared(store(docs), "media"))
