"""Vectorised word work inside tasks: split, hash and window the words of many texts at once.

Words are maximal runs of characters other than space and U+0009 to U+000D.
All work is on the UTF-8 bytes of a slice of texts laid end to end, so the cost
per word is a few array operations and memory is bounded by the slice.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of the splitmix64 generator: spreads 64 bits over 64 bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values for ``seed``."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=U) + U(seed << 32)) * U(0x9E3779B97F4A7C15))


_BYTE = stream(1, 256)
_LOW = stream(2, 1 << 16) | U(1)
_HIGH = stream(3, 1 << 16) | U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def give_back() -> None:
    """Return freed memory to the system.

    Python workers live on between stages, and what they hold counts against
    their executor.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def small(batches: Iterator[pa.RecordBatch], limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into pieces of about ``limit`` bytes, so that a task never
    turns a whole batch into Python objects at once."""
    for b in batches:
        rows = max(1, min(b.num_rows, int(b.num_rows * limit / max(b.nbytes, 1))))
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)
    give_back()


class Words:
    """The words of a list of texts: ``hashes`` of all of them in order, and
    ``bounds``: the words of text ``i`` are ``bounds[i]:bounds[i + 1]``."""

    def __init__(self, texts: list[bytes | None]):
        self.texts = [t or b"" for t in texts]
        lens = np.fromiter((len(t) + 1 for t in self.texts), np.int64, len(self.texts))
        self.offsets = np.concatenate(([0], np.cumsum(lens)))
        self.bytes = np.frombuffer(b"\n".join(self.texts) + b"\n", dtype=np.uint8) if self.texts else np.zeros(0, np.uint8)
        inside = ~_SPACE[self.bytes]
        where = np.flatnonzero(inside)
        if not len(where):
            self.hashes, self.bounds, self.starts = np.zeros(0, U), np.zeros(len(self.texts) + 1, np.int64), where
            return
        first = np.concatenate(([True], np.diff(where) > 1))
        heads = np.flatnonzero(first)
        sizes = np.diff(np.append(heads, len(where)))
        at = np.arange(len(where), dtype=np.int64) - np.repeat(heads, sizes)
        value = _BYTE[self.bytes[where]] * _LOW[at & 0xFFFF]
        if int(sizes.max()) > 0xFFFF:
            value = value * _HIGH[(at >> 16) & 0xFFFF]
        self.hashes = mix(np.add.reduceat(value, heads) + sizes.astype(U) * U(0x9E3779B97F4A7C15))
        self.starts = where[heads]
        self.bounds = np.searchsorted(self.starts, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owner(self) -> np.ndarray:
        """The index of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.texts)), self.counts())

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Start (as a word index) and hash of every run of ``width`` words inside one text."""
        n = len(self.hashes) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U)
        total = np.zeros(n, U)
        for j, c in enumerate(stream(5, width) | U(1)):
            total += self.hashes[j:j + n] * c
        owner = self.owner()
        starts = np.flatnonzero(owner[:n] == owner[width - 1:])
        return starts, mix(total[starts])

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum of a per-byte array over each text."""
        if not len(self.texts):
            return np.zeros(0, np.int64)
        return np.add.reduceat(flags.astype(np.int64), self.offsets[:-1])


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of about ``limit`` bytes; a longer text is a range of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t or b"")
        if size >= limit:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
