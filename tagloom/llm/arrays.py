"""Small numpy helpers that run inside tasks: text buffers, word hashes, local unions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD6E8FEB86659FD93 | 1
_BYTES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TABLES: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, count: int, inverse: bool = False) -> np.ndarray:
    """``base**i`` (or of its inverse) modulo 2**64 for i below ``count``."""
    known = _TABLES.get((base, inverse))
    if known is None or len(known) < count:
        step = pow(base, -1, 1 << 64) if inverse else base
        known = np.full(max(count, 1 << 16), step, np.uint64)
        known[0] = 1
        _TABLES[(base, inverse)] = known = np.multiply.accumulate(known)
    return known[:count]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def byte_values(data: np.ndarray) -> np.ndarray:
    """A fixed 64-bit value for each byte."""
    return _BYTES[data]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each text starts; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of a part have about ``limit`` bytes; a longer text is a part of its own."""
    sizes = np.diff(utf8(batch.column(column))[1])
    first, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield batch.slice(first, i - first)
            first, held = i, 0
        held += n
    if first < batch.num_rows:
        yield batch.slice(first)


def words_of(
    data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends, and how many words come before each text; ``space`` says which bytes part words."""
    solid = ~space[data]
    before, after = np.ones(len(data), bool), np.ones(len(data), bool)
    before[1:], after[:-1] = ~solid[:-1], ~solid[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before[edges] = True
    after[edges - 1] = True
    starts = np.flatnonzero(solid & before)
    ends = np.flatnonzero(solid & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, run: int = 1 << 19) -> np.ndarray:
    """A 64-bit polynomial hash of each word's bytes, worked out over runs of about ``run`` bytes."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        low = starts[at]
        upto = max(at + 1, int(np.searchsorted(ends, low + run, "right")))
        part = data[low : ends[upto - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTES[part] * powers(_BASE, len(part)), out=sums[1:])
        s, e = starts[at:upto] - low, ends[at:upto] - low
        out[at:upto] = (sums[e] - sums[s]) * powers(_BASE, len(part) + 1, True)[s]
        at = upto
    return mixed(out)


def window_hashes(hashes: np.ndarray, size: int, run: int = 1 << 18) -> np.ndarray:
    """Rabin-Karp hashes of all windows of ``size`` consecutive values, whatever text they lie in."""
    count = len(hashes) - size + 1
    out = np.empty(max(0, count), np.uint64)
    for at in range(0, max(0, count), run):
        part = hashes[at : min(count, at + run) + size - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers(_STEP, len(part)), out=sums[1:])
        n = len(part) - size + 1
        out[at : at + n] = (sums[size:] - sums[:-size])[:n] * powers(_STEP, len(part), True)[:n]
    return mixed(out)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    count = len(values) - width + 1
    if count <= 0:
        return values[:0]
    high = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    high[: len(values)] = values
    blocks = high.reshape(-1, width)
    left = np.minimum.accumulate(blocks, 1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(right[:count], left[width - 1 : width - 1 + count])


def merge(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union the classes of ``a[i]`` and ``b[i]`` in place; a label is the smallest index of its class."""
    while len(a):
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while True:
            jumped = labels[labels]
            if (jumped == labels).all():
                break
            labels[:] = jumped


def segment_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes of the value runs ``starts[i]:ends[i]``; empty runs hash to one value."""
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_STEP, len(hashes)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_STEP, len(hashes) + 1, True)[starts] + (ends - starts).astype(np.uint64))
