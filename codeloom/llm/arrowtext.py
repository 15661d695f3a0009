"""Texts of an Arrow batch as flat numpy arrays, so that the work per word or letter is done for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that are worked on at once. A longer single text is worked on alone.
CHUNK_BYTES = 2_000_000

_C1, _C2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)


def mix(x: np.ndarray) -> np.ndarray:
    """An avalanche permutation of 64-bit numbers (the finalizer of SplitMix64)."""
    x = (x ^ (x >> _S30)) * _C1
    x = (x ^ (x >> _S27)) * _C2
    return x ^ (x >> _S31)


def random_numbers(n: int, seed: int) -> np.ndarray:
    """Fixed 64-bit numbers, the same in every process."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + mix(np.full(n, seed, np.uint64)))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after the other, and where each row starts (one more than rows). Null: empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``limit`` bytes of text each, but at least one row."""
    _, offsets = text_bytes(batch.column(column))
    low, n = 0, batch.num_rows
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """As ``text_bytes``, but code points and where each row starts among them."""
    data, offsets = text_bytes(column)
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    firsts = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=firsts[1:])
    return codes, firsts[offsets]


class SpanHasher:
    """64-bit hashes of spans of ``values`` (below 2**32); equal spans hash alike wherever they stand.

    Prefix sums of mixed values times the powers of an odd number; the power at a span's start is divided out again.
    """

    def __init__(self, values: np.ndarray, seed: int = 7):
        base = random_numbers(1, seed)[0] | np.uint64(1)
        n = len(values)
        powers, back = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(int(base), -1, 1 << 64), np.uint64)
        powers[0] = back[0] = 1
        np.cumprod(powers, out=powers)
        self.back = np.cumprod(back, out=back)
        self.sums = np.zeros(n + 1, np.uint64)
        salted = mix(values.astype(np.uint64) + random_numbers(1, seed + 1)[0])
        np.cumsum(salted * powers[:n], out=self.sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashed = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(hashed + (ends - starts).astype(np.uint64) * _C2)


_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z taken as a-z, and where the words of each row start among them (one more than rows).

    A word is a run of characters other than space and the controls 9 to 13.
    """
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    space = _SPACES[data]
    opens, closes = np.empty(len(data), bool), np.empty(len(data), bool)
    opens[0] = closes[-1] = True
    opens[1:] = space[:-1]
    closes[:-1] = space[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    opens[inner] = True
    closes[inner - 1] = True
    starts = np.flatnonzero(opens & ~space)
    ends = np.flatnonzero(closes & ~space) + 1
    return SpanHasher(_LOWER[data]).hashes(starts, ends), np.searchsorted(starts, offsets)
