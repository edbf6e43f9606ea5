"""Vectorised text kernels over Arrow batches (numpy on the UTF-8 buffer, no per-word Python).

Spark partitions and shuffles the documents; these helpers only work inside one Arrow batch. A
batch's strings lie in one contiguous UTF-8 buffer, so word boundaries, word hashes and n-gram
hashes of all documents of the batch are computed with a handful of array passes. Memory is a
small multiple of the batch's bytes; ``bounded_slices`` cuts a batch into byte-bounded slices
(one text is never cut).

Hashes are 64-bit polynomial hashes over a fixed random byte table, finished with a mixer.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa

_RNG = np.random.default_rng(20240611)
BYTE_TABLE = _RNG.integers(1, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 2 ** 64)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0xD6E8FEB86659FD93)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_pow = np.ones(1, dtype=np.uint64)
_inv = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` (mod 2**64) for i < n; grown by doubling and kept per process."""
    global _pow, _inv
    while len(_pow) < n:
        k = len(_pow)
        _pow = np.concatenate([_pow, _pow * np.uint64(pow(_BASE, k, 2 ** 64))])
        _inv = np.concatenate([_inv, _inv * np.uint64(pow(_BASE_INV, k, 2 ** 64))])
    return _pow[:n], _inv[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole 64-bit word (in place)."""
    h ^= h >> np.uint64(30)
    h *= _M1
    h ^= h >> np.uint64(27)
    h *= _M2
    h ^= h >> np.uint64(31)
    return h


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls have length 0. offsets[0] may be above 0."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    else:
        column = column.cast(pa.string())
        kind = np.int32
    n = len(column)
    _, offs, data = column.buffers()
    if n == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offs, dtype=kind)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    if column.null_count:       # a null's bytes, if any, are not part of a text
        valid = np.asarray(column.is_valid())
        if (np.diff(offsets)[~valid] > 0).any():
            return utf8(pa.array([x or "" for x in column.to_pylist()], pa.large_string()))
    return data, offsets


def bounded_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20):
    """Cut a batch into slices whose texts hold at most ``max_bytes`` together (or one text)."""
    if batch.num_rows == 0:
        return
    _, offsets = utf8(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, separates=IS_SPACE):
    """Words (runs of bytes that ``separates`` leaves out: space, \\t, \\n, \\v, \\f, \\r) of every text.

    Returns (hash of each word, words before each text [n + 1], word start byte, word end byte);
    byte positions are relative to ``offsets[0]``. With ``lower``, A-Z count as a-z.
    """
    lo, hi = int(offsets[0]), int(offsets[-1])
    rel = offsets - lo
    raw = data[lo:hi]
    n = len(raw)
    if n == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), z, z
    solid = ~separates[raw]
    edge = np.zeros(n + 1, dtype=bool)          # a text begins here: words do not cross texts
    edge[rel] = True
    before = np.empty(n, dtype=bool)
    before[0] = True
    np.logical_or(~solid[:-1], edge[1:n], out=before[1:])
    after = np.empty(n, dtype=bool)
    after[-1] = True
    np.logical_or(~solid[1:], edge[1:n], out=after[:-1])
    starts = np.flatnonzero(solid & before)
    ends = np.flatnonzero(solid & after) + 1
    power, inverse = _powers(n + 1)
    v = BYTE_TABLE[LOWER[raw] if lower else raw]
    v *= power[:n]
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(v, out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts]
    h += (ends - starts).astype(np.uint64) * _STEP
    return mix(h), np.searchsorted(starts, rel).astype(np.int64), starts, ends


def combine(h: np.ndarray, width: int) -> np.ndarray:
    """Order-sensitive hash of every ``width`` consecutive hashes (length len(h) - width + 1)."""
    m = len(h) - width + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for j in range(1, width):
        out *= _STEP
        out += h[j:j + m]
    return mix(out)


def sequence_hash(h: np.ndarray) -> np.uint64:
    """Order-sensitive hash of a whole sequence of hashes."""
    power, _ = _powers(len(h) + 1)
    total = np.array([(h * power[1:]).sum() + np.uint64(len(h))], dtype=np.uint64)
    return mix(total)[0]


def word_ngrams(h: np.ndarray, before: np.ndarray, width: int):
    """Word n-grams that stay inside one text: (hash, index of the first word, n-grams before each text)."""
    counts = np.diff(before)
    grams = np.maximum(counts - width + 1, 0)
    first = np.concatenate([[0], np.cumsum(grams)])
    total = int(first[-1])
    if total == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), first
    at = np.arange(total) + np.repeat(before[:-1] - first[:-1], grams)
    return combine(h, width)[at], at, first


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Each text's sorted distinct word shingles; a text of 1 to width - 1 words has one shingle
    (its whole word sequence), a text without words none."""
    h, before, _, _ = word_hashes(data, offsets)
    grams, _, first = word_ngrams(h, before, width)
    out = []
    for i in range(len(offsets) - 1):
        words = before[i + 1] - before[i]
        if words >= width:
            out.append(np.unique(grams[first[i]:first[i + 1]]))
        elif words:
            out.append(np.array([sequence_hash(h[before[i]:before[i + 1]])]))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
