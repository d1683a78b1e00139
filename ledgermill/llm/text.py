"""Words and hashes of many texts at once, as numpy arrays.

Texts travel as UTF-8 bytes, so bytes that are no valid UTF-8 do no harm. Null texts count as empty.
Hashes depend on the bytes alone: every task, run and machine gives the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

WHITE = b" \t\n\x0b\x0c\r"
"""Fixed values: what separates words, x20 and x09 to x0D."""

CHUNK_BYTES = 1 << 18
"""Texts are hashed in chunks of about this size; a longer text is a chunk of its own."""

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits in which every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def random_words(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=U64)


@cache
def byte_table(separators: bytes, fold: bool, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Which bytes end a word, and a random number for each byte; ``fold``: A-Z count as a-z."""
    ends = np.zeros(256, bool)
    ends[list(separators)] = True
    values = random_words(seed, 256)
    if fold:
        values[65:91] = values[97:123]
    return ends, values


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses; those for longer chunks are not kept."""

    base = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        size = 2 * CHUNK_BYTES
        if n > size:
            return self.both(n)
        if len(self.up) < size:
            self.up, self.down = self.both(size)
        return self.up[:n], self.down[:n]

    def both(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        return self.run(self.base, n), self.run(pow(self.base, -1, 1 << 64), n)

    @staticmethod
    def run(base: int, n: int) -> np.ndarray:
        factors = np.full(n, base, U64)
        factors[0] = 1
        return np.multiply.accumulate(factors)


POWERS = Powers()


class Texts:
    """Consecutive texts in one buffer: text ``i`` is ``data[bounds[i]:bounds[i + 1]]``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, first: int):
        self.data, self.bounds, self.first = data, bounds, first

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def words(self, separators: bytes = WHITE, fold: bool = False) -> Words:
        return Words(self, separators, fold)


class Words:
    """Words of some texts: ``start`` and ``end`` in the buffer; ``first[i]`` is the first word of text ``i``."""

    def __init__(self, texts: Texts, separators: bytes, fold: bool):
        self.texts, self.separators, self.fold = texts, separators, fold
        data, bounds = texts.data, texts.bounds
        gap = byte_table(separators, fold, 1)[0][data]
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)
        before[1:], after[:-1] = gap[:-1], gap[1:]
        before[bounds[:-1][bounds[:-1] < len(data)]] = True
        after[bounds[1:][bounds[1:] > 0] - 1] = True
        self.start = np.flatnonzero(before & ~gap)
        self.end = np.flatnonzero(after & ~gap) + 1
        self.first = np.searchsorted(self.start, bounds)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self, seed: int = 1) -> np.ndarray:
        """A polynomial in the bytes of each word, cut out of one running sum."""
        data = self.texts.data
        up, down = POWERS.of(len(data) + 1)
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(byte_table(self.separators, self.fold, seed)[1][data] * up[: len(data)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(U64))


def span_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, joined from those of runs half as long."""
    if n == 1 or len(words) < n:
        return words[: max(0, len(words) - n + 1)]
    half = span_hashes(words, n // 2)
    runs = half[: len(half) - n // 2] * U64(0xBF58476D1CE4E5B9) + half[n // 2 :]
    if n % 2:
        runs = runs[:-1] * U64(0x94D049BB133111EB) + words[n - 1 :]
    return mix(runs)


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """For every run of ``n`` consecutive words: whether one text holds it all."""
    total = first[-1]
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    return text[: max(0, total - n + 1)] == text[n - 1 :] if total >= n else np.zeros(0, bool)


def buffers(column: pa.ChunkedArray | pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and bounds of each piece of a binary column; nulls are empty."""
    row = 0
    for piece in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        if len(piece):
            if piece.null_count:
                piece = piece.fill_null(b"")
            kind = np.int64 if pa.types.is_large_binary(piece.type) else np.int32
            _, offsets, values = piece.buffers()
            bounds = np.frombuffer(offsets, kind)[piece.offset : piece.offset + len(piece) + 1].astype(np.int64)
            data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
            yield row, data[bounds[0] : bounds[-1]], bounds - bounds[0]
            row += len(piece)


def chunks(column: pa.ChunkedArray | pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column's texts in order, in chunks of about ``limit`` bytes; no text is cut."""
    for row, data, bounds in buffers(column):
        at, last = 0, len(bounds) - 1
        while at < last:
            to = int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1
            to = min(max(to, at + 1), last)
            yield Texts(data[bounds[at] : bounds[to]], bounds[at : to + 1] - bounds[at], row + at)
            at = to


def binary(values: list[bytes | None]) -> pa.Array:
    return pa.array(values, pa.binary())
