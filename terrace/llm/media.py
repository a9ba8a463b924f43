"""Operator 6: media columns, here sound: WAV files as binary columns and their spectral fingerprints.

A payload of bytes is stored as the samples of an 8-bit mono WAV file, in a Parquet table. The stored file is read by the
wave module, cut into overlapping frames, and transformed by a short-time Fourier transform. Points
of the spectrogram that no other within some frames and bins outdoes are peaks, and each peak is paired with
the next ones of later frames: a pair's code holds both bins and the frames between them, its time is coded as the
frames since the pair before. Both arrays are stored as columns of a second table.

Defined results: a null text is an empty one, whose payload is all padding; equal texts give equal
files and fingerprints; a file of one frame has no pair; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm.common import binary_rows, slices, stored
from terrace.llm.tokens import text_blocks

#: Samples a second; bytes that a payload's length is a multiple of; samples of a frame and between frames.
RATE, UNIT, FRAME, HOP = 8000, 576, 576, 288
#: Frames and bins around a peak that it outdoes; the lowest bin; least share of the strongest value of its frame.
FRAMES, BINS, LOWEST, SHARE = 2, 16, 2, 1e-3
#: Pairs that a peak starts at most, frames between its two peaks at most, frames transformed at a time.
FAN, REACH, BLOCK = 3, 32, 2048
_WINDOW = np.hanning(FRAME).astype(np.float32)


def to_wav(payload: bytes) -> bytes:
    """A WAV file whose 8-bit samples are the payload."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def _widest(s: np.ndarray, reach: int) -> np.ndarray:
    """The largest value within ``reach`` rows of each."""
    out = s.copy()
    for k in range(1, min(reach, len(s) - 1) + 1):
        np.maximum(out[k:], s[:-k], out=out[k:])
        np.maximum(out[:-k], s[k:], out=out[:-k])
    return out


def spectrogram(samples: np.ndarray, first: int, last: int) -> np.ndarray:
    """Magnitudes of the frames first..last-1, by bin."""
    frames = np.lib.stride_tricks.sliding_window_view(samples, FRAME)[::HOP][first:last]
    return np.abs(np.fft.rfft((frames.astype(np.float32) - np.float32(128)) * _WINDOW, axis=1))


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frame, bin) of the spectrogram's peaks, in order."""
    n = (len(samples) - FRAME) // HOP + 1
    times, bins = [], []
    for at in range(0, n, BLOCK):
        first, last = max(0, at - FRAMES), min(n, at + BLOCK + FRAMES)
        s = spectrogram(samples, first, last)
        high = s[:, LOWEST:]
        top = _widest(_widest(high.T, BINS).T, FRAMES)
        t, b = np.nonzero((high >= top) & (high > SHARE * s.max(axis=1, keepdims=True)))
        own = (t + first >= at) & (t + first < at + BLOCK)
        times.append(t[own] + first)
        bins.append(b[own] + LOWEST)
    return np.concatenate(times), np.concatenate(bins)


def fingerprint(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames since the pair before, pair codes)."""
    t, b = peaks(samples)
    after = np.searchsorted(t, t, side="right")
    times, codes = [], []
    for k in range(FAN):
        i = np.flatnonzero(after + k < len(t))
        j = after[i] + k
        near = t[j] - t[i] <= REACH
        i, j = i[near], j[near]
        times.append(t[i])
        codes.append(b[i] << 20 | b[j] << 8 | t[j] - t[i])
    when, code = np.concatenate(times), np.concatenate(codes)
    order = np.lexsort((code, when))
    return np.diff(when[order], prepend=0), code[order]


def with_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes and the WAV file (media) of every text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x for b in batches for x in text_blocks(b, text_col)):
            raw = binary_rows(batch, text_col)
            media = [to_wav(x + b"\xff" * (UNIT - len(x) % UNIT if len(x) % UNIT or not x else 0)) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(map(len, raw), pa.int64()), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(rows, f"{id_col} long, n_bytes long, media binary")


def with_fingerprints(media: DataFrame) -> DataFrame:
    """The columns before media, what is read back of each WAV file (sizes and checksums), and times and codes: its fingerprint as arrays."""
    kept = [f for f in media.schema.fields if f.name != "media"]
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "times", "codes"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for x in batch.column(len(kept)).to_pylist():
                payload = from_wav(x)
                times, codes = fingerprint(np.frombuffer(payload, np.uint8))
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(x), hashlib.sha256(x).hexdigest(), times.astype(np.int32), codes.astype(np.int32)))
            found = zip(*out, strict=True) if out else [()] * len(names)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *(pa.array(c, t) for c, t in zip(found, kinds, strict=True))], [*(f.name for f in kept), *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return media.select(*(f.name for f in kept), "media").mapInArrow(rows, f"{schema}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, times array<int>, codes array<int>")


def digests(docs: DataFrame) -> DataFrame:
    """Both tables written to the shared folder and read back; of the arrays, a digest as ``feature``."""
    found = stored(with_fingerprints(stored(with_media(docs), "media")), "fingerprints")
    feature = F.concat_ws(":", F.size("codes").cast("string"), F.sha2(F.concat_ws(" ", F.col("times").cast("array<string>"), F.col("codes").cast("array<string>")), 256))
    return found.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))
