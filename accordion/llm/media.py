"""Operator 6, media columns: text payloads kept as WAV, with spectral fingerprints.

The payload is the text's UTF-8 bytes (null: none) and zero bytes up to a positive
multiple of 64. It is stored without loss as mono 8-bit WAV by the ``wave`` module and
read back from the stored bytes; everything else is computed from what was read back.
A short-time Fourier transform (Hann, 256 samples, hop 128; a short payload is filled
with silence to one frame) gives each frame's three strongest local peaks. Each peak is
paired with the strongest peak of the next two frames, and a pair is stored as one long:
time code << 24 | peak << 16 | partner << 8 | frames between. Rows are independent, so
equal texts have equal values; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

UNIT, RATE, FRAME, HOP, PEAKS, REACH = 64, 8000, 256, 128, 3, 2
_WINDOW = np.hanning(FRAME).astype(np.float32)


def to_wav(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    with wave.open(io.BytesIO(stored), "rb") as r:
        return r.readframes(r.getnframes())


def fingerprints(payloads: list[bytes]) -> list[np.ndarray]:
    """The time-coded peak pairs of each payload."""
    signals = [np.frombuffer(p, np.uint8) for p in payloads]
    frames = [max(1, 1 + -(-max(0, len(s) - FRAME) // HOP)) for s in signals]
    bounds = np.r_[0, np.cumsum(frames)]
    pairs: list[list[np.ndarray]] = [[] for _ in payloads]
    # Whole signals in groups of at most about 16,000 frames; a longer one by itself.
    begin = 0
    while begin < len(signals):
        end = max(begin + 1, int(np.searchsorted(bounds, bounds[begin] + 16_000, "right")) - 1)
        for i, found in zip(range(begin, end), _pairs(signals[begin:end], frames[begin:end]), strict=True):
            pairs[i] = found
        begin = end
    return pairs


def _peaks(signal: np.ndarray, n: int) -> np.ndarray:
    """Bins of the strongest local peaks of each of n frames, strongest first (0: none)."""
    filled = np.full((n - 1) * HOP + FRAME, 128, np.uint8)
    filled[: len(signal)] = signal
    halves = (filled.astype(np.float32) - 128).reshape(-1, HOP)
    out = np.zeros((n, PEAKS), np.int64)
    for a in range(0, n, 16_000):
        b = min(n, a + 16_000)
        power = np.abs(np.fft.rfft(np.concatenate([halves[a:b], halves[a + 1 : b + 1]], 1) * _WINDOW))
        out[a:b] = _strongest(power)
    return out


def _strongest(power: np.ndarray) -> np.ndarray:
    inner = power[:, 1:-1]
    level = np.where((inner > power[:, :-2]) & (inner >= power[:, 2:]), inner, np.float32(0))
    out = np.zeros((len(power), PEAKS), np.int64)
    row = np.arange(len(power))
    for p in range(PEAKS):
        best = level.argmax(1)
        out[:, p] = np.where(level[row, best] > 0, best + 1, 0)
        level[row, best] = 0
    return out


def _pairs(signals: list[np.ndarray], frames: list[int]) -> list[np.ndarray]:
    if len(signals) == 1:
        peaks = _peaks(signals[0], frames[0])
    else:
        filled = np.full(sum(((n - 1) * HOP + FRAME) for n in frames), 128, np.uint8)
        at, firsts = 0, []
        for s, n in zip(signals, frames, strict=True):
            filled[at : at + len(s)] = s
            firsts.append(at // HOP + np.arange(n))
            at += (n - 1) * HOP + FRAME
        halves = (filled.astype(np.float32) - 128).reshape(-1, HOP)
        first = np.concatenate(firsts)
        peaks = _strongest(np.abs(np.fft.rfft(np.concatenate([halves[first], halves[first + 1]], 1) * _WINDOW)))
    out, begin = [], 0
    for n in frames:
        own = peaks[begin : begin + n]
        codes = []
        for step in range(1, min(REACH, n - 1) + 1):
            anchor, partner = own[:-step], own[step:, :1]
            code = (np.arange(n - step)[:, None] << 24) | (anchor << 16) | (partner << 8) | step
            codes.append(code[(anchor > 0) & (partner > 0)])
        out.append(np.sort(np.concatenate(codes)) if codes else np.zeros(0, np.int64))
        begin += n
    return out


def media_rows(docs: DataFrame, with_media: bool = False) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256,
    feature; with ``with_media`` also media (WAV bytes) and fingerprint (array of longs)."""
    kinds = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    if with_media:
        kinds += [("media", pa.binary()), ("fingerprint", pa.list_(pa.int64()))]
        schema += ", media binary, fingerprint array<bigint>"

    def made(batches):
        for s in C.slices_of(batches, 2 << 20):
            data, offsets = C.texts_of(s)
            raw = data.tobytes()
            sizes, wavs, back = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                wav = to_wav(raw[a:b].ljust(max(UNIT, -(-(b - a) // UNIT) * UNIT), b"\0"))
                sizes.append(b - a)
                wavs.append(wav)
                back.append(from_wav(wav))
            prints = fingerprints(back)
            sha = lambda x: hashlib.sha256(x).hexdigest()
            cols = [sizes, [len(p) for p in back], [sha(p) for p in back], [zlib.crc32(p[-UNIT:]) for p in back], [len(w) for w in wavs], [sha(w) for w in wavs], [f"{len(p)}:{sha(p.astype('<i8').tobytes())[:32]}" for p in prints]]
            if with_media:
                cols += [wavs, None]
            arrays = [s.column(s.schema.get_field_index("doc_id")).cast(pa.int64()), *(pa.array(c, t) for c, (_, t) in zip(cols, kinds, strict=True) if c is not None)]
            if with_media:
                bounds = np.r_[0, np.cumsum([len(p) for p in prints])]
                arrays.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(prints) if prints else np.zeros(0, np.int64))))
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(n for n, _ in kinds)])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(made, schema)


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_rows(C.shipped(spark).read.parquet(f"{sf_dir}/documents.parquet"), with_media=True)
