"""Vectorised splitting and hashing of the UTF-8 bytes of Arrow text columns.

Shared by the operators that look at words: a column is cut into chunks of a few MB, whose texts are laid end to end
with a newline around each, so that word and line boundaries are found with whole-array numpy operations.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U = np.uint64
#: ASCII white space \x09-\x0D and \x20, as in the word patterns of the operators.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, other bytes unchanged (so multi-byte characters stay whole).
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SALT = np.random.RandomState(20240229).randint(1, 1 << 63, 256).astype(U)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, U), np.ones(1, U))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over the whole range (a bijection)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _powers_upto(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        up, down = np.full(n, _BASE, U), np.full(n, _INVERSE, U)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def give_back() -> None:
    """Free memory of this process goes back to the system, where its C library can do that."""
    global _powers
    _powers = np.ones(1, U), np.ones(1, U)
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work of a task, after which its worker gives back what is free.

    Workers live on, beside their executor's heap, through all stages of a job; each would keep the most that any task took.
    """

    @wraps(work)
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(it)
        finally:
            give_back()

    return run


def lean_group(work: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same work on a group; after one of more than a chunk, the worker gives back what is free."""

    @wraps(work)
    def run(table: pa.Table) -> pa.Table:
        large = table.nbytes > CHUNK_BYTES
        try:
            return work(table)
        finally:
            if large:
                give_back()

    return run


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with about `most` bytes of text each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes), 0
    while at < batch.num_rows:
        stop = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
        stop = max(stop, at + 1)
        yield batch.slice(at, stop - at)
        at = stop


class Texts:
    """The texts of a column, end to end; null counts as empty."""

    def __init__(self, column: pa.Array, table: np.ndarray | None = None):
        raw = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
        joined = b"\n".join([b"", *raw.to_pylist(), b""])
        self.data = np.frombuffer(joined, np.uint8)
        if table is not None:
            self.data = table[self.data]
        self.sizes = pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64)
        self.ends = np.cumsum(self.sizes + 1)
        self.starts = self.ends - self.sizes
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.sizes)

    def spans(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes outside the separator table."""
        inside = ~separator[self.data]
        flips = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        return flips[0::2], flips[1::2]

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the lines between newlines; every text has one at least."""
        breaks = np.flatnonzero(self.data == 10)
        return breaks[:-1] + 1, breaks[1:]

    def owner(self, positions: np.ndarray) -> np.ndarray:
        """The text in which each position lies (its closing newline included)."""
        return np.searchsorted(self.ends, positions, "left")

    def count(self, table: np.ndarray) -> np.ndarray:
        """For each text, its bytes that are in the table."""
        total = np.concatenate([[0], np.cumsum(table[self.data], dtype=np.int64)])
        return total[self.ends] - total[self.starts]

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span."""
        up, down = _powers_upto(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, U)
            np.cumsum(_SALT[self.data] * up[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * down[starts] + (ends - starts).astype(U))


def windows(hashes: np.ndarray, owners: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and index of the first word of every run of `size` words that lies in one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64)
    out = np.zeros(n, U)
    for k in range(size):
        out = out * U(0x100000001B3) + mix(hashes[k : k + n] + U(k + 1))
    whole = np.flatnonzero(owners[:n] == owners[size - 1 :])
    return mix(out[whole]), whole


def of_text(hashes: np.ndarray, owners: np.ndarray) -> np.ndarray:
    """The hashes told apart by the text they are in."""
    return mix(hashes + mix(owners.astype(U) + U(1)))
