"""Media columns: byte payloads stored as 8-bit WAV, read back, and fingerprinted.

``wave`` writes and reads mono 8-bit samples. Of the samples read back, a short-time Fourier transform (Hann window)
gives magnitudes; in each frame the strongest local maxima above the frame's mean (else its strongest bin) are peaks;
each peak is paired with the peaks of the next frames (target zone) to a landmark (frequency 1, frequency 2, frame
distance) at a frame. Frames overlap by three quarters, the first and last reach over the payload's ends: each sample
lies in four frames, near the middle of one. Payloads that differ by a gain alone (as 'a' and 'b') share landmarks.
Landmarks are stored as time-coded arrays: ``times`` and the packed ``marks`` beside them.

Null text counts as empty; its payload is 64 zero bytes. Samples are transformed in blocks of frames, so memory is
bounded by the payload and one block. A silent payload (all samples equal) has no landmarks, any other has some.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import id_text, map_arrow, table

RATE = 8000
FRAME, HOP = 1024, 256
PEAKS, ZONE, BLOCK = 3, 2, 2048
_HANN = np.hanning(FRAME).astype("f4")


def payload_of(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded with zeros to a positive multiple of 64, and the length before."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % 64 if raw else 64), len(raw)


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> tuple[bytes, int]:
    """Samples and rate of an 8-bit mono file."""
    with wave.open(io.BytesIO(media), "rb") as w:
        if (w.getnchannels(), w.getsampwidth()) != (1, 1):
            raise ValueError("8-bit mono is expected")
        return w.readframes(w.getnframes()), w.getframerate()


def peaks_of(samples: bytes) -> np.ndarray:
    """(frames, PEAKS) bins of the strongest local maxima, by falling strength; 0 where there are fewer."""
    x = np.frombuffer(samples, "u1")
    mean, lead = x.mean(), FRAME - HOP
    n = -(-(len(x) + lead) // HOP)
    out = np.zeros((n, PEAKS), "i4")
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        part = np.zeros((b - a - 1) * HOP + FRAME, "f4")
        at = a * HOP - lead
        own = x[max(at, 0) : at + len(part)]
        part[max(-at, 0) : max(-at, 0) + len(own)] = own - mean
        frames = np.lib.stride_tricks.sliding_window_view(part, FRAME)[::HOP]
        size = np.abs(np.fft.rfft((frames - frames.mean(axis=1, keepdims=True)) * _HANN, axis=1)).astype("f4")
        mid = size[:, 1:-1]
        top = (mid > size[:, :-2]) & (mid >= size[:, 2:]) & (mid > 2 * mid.mean(axis=1, keepdims=True))
        bare = np.flatnonzero(~top.any(axis=1))
        top[bare, mid[bare].argmax(axis=1)] = True
        level = np.where(top, np.round(mid, 1), -1)
        best = np.argpartition(-level, PEAKS, axis=1)[:, : 2 * PEAKS] if PEAKS * 2 < level.shape[1] else np.argsort(-level, axis=1)
        best = np.sort(best, axis=1)
        order = np.argsort(-np.take_along_axis(level, best, 1), axis=1, kind="stable")[:, :PEAKS]
        best = np.take_along_axis(best, order, 1)
        out[a:b] = np.where(np.take_along_axis(level, best, 1) > 0, best + 1, 0)
    return out


def landmarks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frame numbers and packed pairs (f1 << 20 | f2 << 8 | distance), by time."""
    peaks = peaks_of(samples)
    times, marks = [], []
    for gap in range(1, ZONE + 1):
        early, late = peaks[:-gap], peaks[gap:]
        a, b = np.repeat(early, PEAKS, 1), np.tile(late, (1, PEAKS))
        t, k = np.nonzero((a > 0) & (b > 0))
        times.append(t)
        marks.append((a[t, k].astype("i8") << 20) | (b[t, k].astype("i8") << 8) | gap)
    t, m = np.concatenate(times), np.concatenate(marks)
    order = np.lexsort((m, t))
    return t[order].astype("i4"), m[order]


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_marks long, times array<int>, marks array<long>, media binary"


def media_column(docs: DataFrame, keep_media: bool = False) -> DataFrame:
    """The stored form (if ``keep_media``), what was read back from it, and its fingerprint arrays."""

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {n: [] for n in ("n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_marks", "times", "marks", "media")}
        for text in batch.column(1).to_pylist():
            payload, n = payload_of(text)
            media = to_wav(payload)
            back, _ = from_wav(media)
            times, marks = landmarks(back)
            row = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media), hashlib.sha256(media).hexdigest(),
                   f"{len(marks)}:{hashlib.sha256(times.tobytes() + marks.tobytes()).hexdigest()[:32]}", len(marks), times, marks, media if keep_media else None)
            for column, value in zip(out.values(), row, strict=True):
                column.append(value)
        return {"doc_id": batch.column(0)} | out

    return map_arrow(id_text(docs), run, SCHEMA)


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_column(table(spark, sf_dir, "documents")).drop("media")
