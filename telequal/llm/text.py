"""Vectorised helpers for task code: blocks of whole texts, words and word hashes.

All functions work on one block of bytes, the UTF-8 texts of some documents, each followed by one blank.
Blocks hold about ``BLOCK_BYTES``, or one document if that is longer, so memory follows the longest document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from telequal.session import batches_of  # noqa: F401 (used as text.batches_of)

BLOCK_BYTES = 2 << 20

#: Bytes of words between white space, and of words of letters and digits (any byte above ASCII counts as one).
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64 and of its inverse."""
    if len(_powers[0]) < n:
        _powers[0] = _geometric(_BASE, n)
        _powers[1] = _geometric(pow(_BASE, -1, 2**64), n)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes sum to about ``limit``; every row is in exactly one."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n + 1
    if start < len(sizes):
        yield start, len(sizes)


class Block:
    """Texts of consecutive rows: ``data`` with a blank after each, ``start``/``end`` of each in bytes."""

    def __init__(self, batch: pa.RecordBatch, texts: list[bytes], lower: bool = True) -> None:
        self.batch = batch
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        self.data = LOWER[data] if lower else data
        self.end = np.cumsum(lengths + 1) - 1
        self.start = self.end - lengths

    def __len__(self) -> int:
        return len(self.start)

    def words(self, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end and row of every word."""
        inside = kind[self.data]
        edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
        first, last = edge[::2], edge[1::2]
        return first, last, np.searchsorted(self.end, first)

    def hashes(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte range, alike in every block."""
        up, down = powers(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], out=sums[1:])
        return mix((sums[last] - sums[first]) * down[first])


def blocks(batches, column: str = "text", lower: bool = True, size: int = BLOCK_BYTES) -> Iterator[Block]:
    """The rows of Arrow batches, in order, as blocks; a null text is empty."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_binary()).fill_null(b"").to_pylist()
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        for a, b in slices(sizes, size):
            yield Block(batch.slice(a, b - a), texts[a:b], lower)


def offsets(row: np.ndarray, n: int) -> np.ndarray:
    """Where each row's entries begin in an array sorted by row, and its length at the end."""
    return np.searchsorted(row, np.arange(n + 1))


def expand(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every range first..first+count-1 its values, and the index of the range that each is from."""
    owner = np.repeat(np.arange(len(count)), count)
    return np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count) + first[owner], owner


def sequence_hash(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of each run of ``length`` consecutive word hashes."""
    n = max(0, len(words) - length + 1)
    out = np.full(n, length, np.uint64)
    for j in range(length):
        out = out * np.uint64(0xD6E8FEB86659FD93) + words[j : j + n]
    return mix(out)


def with_columns(batch: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """The batch with columns added or replaced."""
    names, arrays = list(batch.schema.names), list(batch.columns)
    for name, values in columns.items():
        if name in names:
            arrays[names.index(name)] = values
        else:
            names.append(name)
            arrays.append(values)
    return pa.RecordBatch.from_arrays(arrays, names=names)


def lists(flat, counts: np.ndarray) -> pa.Array:
    """A list column from its flat values and the length of each list."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), flat)
