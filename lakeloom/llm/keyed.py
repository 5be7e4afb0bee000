"""Sorted 64-bit keys with counts, as few bytes; and ranges of keys.

Operators that count hashed words or n-grams send each chunk's distinct keys
to reduce tasks by ranges of the key. At most ``MOST_PARTITIONS`` ranges are
written by a chunk; where the input needs more and smaller ones, the reduce
side deals each blob out once more and Spark's sort brings them together.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

MOST_PARTITIONS = 20_000


def plan_ranges(session: int, size: int, range_bytes: int) -> tuple[int, int]:
    """Partitions, and ranges in each, for ``size`` bytes in all."""
    want = max(session, -(-size // range_bytes))
    parts = min(want, max(session, MOST_PARTITIONS))
    return parts, -(-want // parts)


def edges(of: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of equal values of an ascending array."""
    at = np.append(np.flatnonzero(np.diff(of, prepend=-1)), len(of)).tolist()
    return list(zip(at, at[1:]))


def _small(values: np.ndarray) -> bytes:
    """One byte each; what does not fit follows in full."""
    fits = (values >= 0) & (values < 255)
    return np.where(fits, values, 255).astype(np.uint8).tobytes() + values[~fits].astype("<i8").tobytes()


def _unsmall(data: bytes, n: int, at: int) -> tuple[np.ndarray, int]:
    out = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    wide = out == 255
    k = int(wide.sum())
    out[wide] = np.frombuffer(data, "<i8", k, at + n)
    return out, at + n + 8 * k


def press(keys: np.ndarray, *counts: np.ndarray) -> bytes:
    """Ascending keys as differences, byte by byte of each, and their counts."""
    gaps = np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8)
    width = max(1, int(np.flatnonzero(gaps.any(axis=0))[-1]) + 1) if gaps.any() else 1
    return struct.pack("<IBB", len(keys), width, len(counts)) + gaps[:, :width].T.tobytes() + b"".join(map(_small, counts))


def unpress(data: bytes, at: int = 0) -> tuple[np.ndarray, list[np.ndarray], int]:
    """Keys, their counts and where the next of several begins."""
    n, width, k = struct.unpack_from("<IBB", data, at)
    at += 6
    gaps = np.zeros((n, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n).T
    at += n * width
    counts = []
    for _ in range(k):
        c, at = _unsmall(data, n, at)
        counts.append(c)
    return np.cumsum(gaps.view("<u8").ravel(), dtype=np.uint64), counts, at


def squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def unsqueeze(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)
