"""Trimming of the second mate in Arrow batches: adapters, low ends, sliding window. Numpy works on whole batches, since
aligning every adapter at every place of a read by array functions costs far more."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cellquant.functions.seq import PHRED

ROWS = 4096


def _matrix(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows x longest bytes, lengths); null is empty."""
    data = strings.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(data.buffers()[1], np.int64)[data.offset : data.offset + len(data) + 1]
    n = np.diff(ends)
    out = np.zeros((len(n), int(n.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < n[:, None]] = np.frombuffer(data.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return out, n


def clipped(seq: np.ndarray, end: np.ndarray, adapter: bytes, least: int, rate: float) -> np.ndarray:
    """Where each read ends after clipping: the leftmost place where it and the adapter overlap by ``least`` bases or more
    with mismatches of at most ``rate`` of the overlap."""
    places = seq.shape[1] - least + 1
    if places < 1 or not adapter:
        return end
    wide = np.pad(seq, ((0, 0), (0, len(adapter))))
    at = np.arange(places)
    left = end[:, None] - at
    wrong = np.zeros((len(seq), places), np.int16)
    for k, base in enumerate(adapter):
        wrong += (wide[:, k : k + places] != base) & (left > k)
    overlap = np.minimum(len(adapter), left)
    fits = (overlap >= least) & (wrong <= rate * overlap)
    return np.where(fits.any(1), fits.argmax(1), end)


def window(q: np.ndarray, end: np.ndarray, quality: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of what is left of reads with the quality symbols ``q`` that end at ``end``: without low ends, up to the first
    window of ``width`` bases whose mean is under ``quality``."""
    q = np.maximum(q.astype(np.int32) - PHRED, 0)
    places = np.arange(q.shape[1])
    good = (q >= quality) & (places < end[:, None])
    some = good.any(1)
    start = np.where(some, good.argmax(1), 0)
    end = np.where(some, q.shape[1] - good[:, ::-1].argmax(1), 0)
    if q.shape[1] >= width:
        total = np.cumsum(np.pad(q, ((0, 0), (1, 0))), axis=1)
        at = places[: q.shape[1] - width + 1]
        low = (total[:, width:] - total[:, :-width] < width * quality) & (at >= start[:, None]) & (at + width <= end[:, None])
        end = np.where(low.any(1), low.argmax(1), end)
    return start.astype(np.int32), end.astype(np.int32)


def trimmed(seq: pa.Array, qual: pa.Array, adapters: Sequence[bytes], quality: int, width: int, least: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of what is left of each read; a read whose bases are all low, or that has none, gives (0, 0)."""
    s, end = _matrix(seq)
    q, _ = _matrix(qual)
    q = np.pad(q, ((0, 0), (0, max(0, s.shape[1] - q.shape[1]))))[:, : s.shape[1]]
    for a in adapters:
        end = clipped(s, end, a, least, rate)
    return window(q, end, quality, width)


def trim_span(seq: Column, qual: Column, adapters: Sequence[str] = (), quality: int = 20, width: int = 4, least: int = 5, rate: float = 0.1) -> Column:
    """struct<start, end>, 0-based half-open: ``adapters`` clip one after the other what the ones before left, then low ends
    go, then all from the first window of ``width`` bases whose mean is under ``quality``. Null reads give (0, 0)."""
    listed = [a.encode() for a in adapters]

    @F.arrow_udf("struct<start:int,end:int>")
    def span(seq: pa.Array, qual: pa.Array) -> pa.Array:
        parts = [trimmed(seq.slice(lo, ROWS), qual.slice(lo, ROWS), listed, quality, width, least, rate) for lo in range(0, len(seq), ROWS)]
        start, end = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int32) for k in (0, 1))
        return pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "end"])

    return span(seq, qual)


def window_span(qual: Column, quality: int, width: int = 4) -> Column:
    """struct<start, end> as ``seq.quality_window`` gives it of quality strings, which are ASCII; the array functions there work
    through every window of every read one by one."""

    @F.arrow_udf("struct<start:int,end:int>")
    def span(qual: pa.Array) -> pa.Array:
        parts = [window(*_matrix(qual.slice(lo, ROWS)), quality, width) for lo in range(0, len(qual), ROWS)]
        start, end = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int32) for k in (0, 1))
        return pa.StructArray.from_arrays([pa.array(start), pa.array(end)], ["start", "end"])

    return span(qual)
