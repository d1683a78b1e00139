"""Benchmark decontamination: SimHash of item-sized windows, searched by multi-index Hamming blocks.

Items and documents become word shingles (A-Z lower-cased, five words; an item of fewer words is one
shingle). For every item length, windows of as many words slide over a document by one word. A window's
64-bit SimHash is held against those of the items of that length: fingerprints are cut into 8 blocks of 8
bits, and two that differ in at most ``RADIUS`` bits agree up to ``ERRORS`` bits in some block (pigeonhole),
so a table of 256 values for each block, with the values up to that many bits away filled in, finds all of
them. At similarity 0.75, 11 bits differ on average, with a standard deviation of 3. Found pairs are
verified: weighted Jaccard similarity of the shingles, a shingle's weight being how often it occurs.

Windows without any shingle of an item have similarity 0 with all of them and get no fingerprint.

Items are read in blocks of bounded size; every task gets one block at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import ceil
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.jobs import by_batch, utf8
from ledgermill.llm.text import U64, Words, chunks, inside, mix, span_hashes

SHINGLE, SIMILARITY = 5, 0.75

BLOCKS, ERRORS = 8, 2
RADIUS = BLOCKS * (ERRORS + 1) - 1

ITEM_BYTES = 4 << 20
"""Bound of the items' text that a task gets at once."""

SIEVE_BITS = 20

STRETCH = 1 << 14
"""Words of a text whose windows are held at once, 256 bytes each: a text of any length takes no more."""


class Item(NamedTuple):
    item_id: int | None
    words: int
    size: int  # words of a shingle
    shingles: Counter
    fingerprint: int


class Match(NamedTuple):
    row: int
    item_id: int | None
    start: int
    n_words: int
    similarity: float


def signs(shingles: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 for each shingle: the bits of its hash."""
    bits = np.unpackbits(mix(shingles).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=-1, bitorder="little").view("<u8").reshape(len(sums))


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


class Length:
    """The items of one length, and their fingerprints' blocks."""

    def __init__(self, items: list[Item]):
        self.items, self.words, self.size = items, items[0].words, items[0].size
        self.shingles = self.words - self.size + 1
        self.fingerprints = np.array([i.fingerprint for i in items], U64)
        values = np.arange(256, dtype=np.uint8)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= ERRORS
        blocks = self.fingerprints.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        self.tables = np.stack([near[:, blocks[:, b]] for b in range(BLOCKS)])  # block, value, item

    def within_radius(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of fingerprints and items that are within the radius of each other."""
        blocks = found.astype("<u8").view(np.uint8).reshape(-1, BLOCKS)
        candidate = np.zeros((len(found), len(self.items)), bool)
        for b in range(BLOCKS):
            candidate |= self.tables[b][blocks[:, b]]
        which, item = np.nonzero(candidate)
        use = np.bitwise_count(found[which] ^ self.fingerprints[item]) <= RADIUS
        return which[use], item[use]


class Items:
    """A block of benchmark items."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        by_length: dict[int, list[Item]] = {}
        every: dict[int, list[np.ndarray]] = {}
        column = pa.array([text for _, text in rows], pa.binary())
        for texts in chunks(column):
            words = texts.words(fold=True)
            hashes = words.hashes()
            for i in range(len(texts)):
                own = hashes[words.first[i] : words.first[i + 1]]
                if not len(own):
                    continue
                size = min(SHINGLE, len(own))
                runs = span_hashes(own, size)
                mark = int(fingerprints(signs(runs).sum(0)[None, :])[0])
                item = Item(rows[texts.first + i][0], len(own), size, Counter(runs.tolist()), mark)
                by_length.setdefault(len(own), []).append(item)
                every.setdefault(size, []).append(runs)
        self.lengths = [Length(by_length[n]) for n in sorted(by_length)]
        self.known = {size: np.unique(np.concatenate(runs)) for size, runs in every.items()}
        self.sieves = {}
        for size, known in self.known.items():
            self.sieves[size] = np.zeros(1 << SIEVE_BITS, bool)
            self.sieves[size][known >> U64(64 - SIEVE_BITS)] = True

    def hits(self, runs: np.ndarray, size: int) -> np.ndarray:
        """Where a shingle of an item stands."""
        at = np.flatnonzero(self.sieves[size][runs >> U64(64 - SIEVE_BITS)])
        known = self.known[size]
        place = np.minimum(np.searchsorted(known, runs[at]), len(known) - 1)
        return at[known[place] == runs[at]]

    def matches(self, column: pa.ChunkedArray | pa.Array) -> Iterator[Match]:
        """The best window of every row and item that are similar enough."""
        for texts in chunks(column):
            words = texts.words(fold=True)
            hashes = words.hashes()
            for size in self.known:
                if len(hashes) < size:
                    continue
                runs = span_hashes(hashes, size)
                at = self.hits(runs, size)
                at = at[inside(words.first, size)[at]]
                if len(at):
                    row = np.searchsorted(words.first, at, "right") - 1
                    for r in np.unique(row):
                        yield from self.in_row(words, runs, at[row == r], int(r), size)

    def in_row(self, words: Words, runs: np.ndarray, at: np.ndarray, row: int, size: int) -> Iterator[Match]:
        first, last = int(words.first[row]), int(words.first[row + 1])
        reach = max(length.words for length in self.lengths if length.size == size)
        # stretches of the row that windows over a hit can reach, apart from each other
        gaps = np.flatnonzero(np.diff(at) > 2 * reach) + 1
        best: dict[tuple[int, int], Match] = {}
        for part in np.split(at, gaps):
            low, high = max(first, int(part[0]) - reach), min(last, int(part[-1]) + size + reach)
            for at_once in range(low, high, STRETCH):
                self.in_stretch(runs, part, (at_once, min(high, at_once + STRETCH + reach)), (first, last), size, best, words.texts.first + row)
        yield from best.values()

    def in_stretch(
        self, runs: np.ndarray, part: np.ndarray, stretch: tuple[int, int], text: tuple[int, int], size: int, best: dict, row: int
    ) -> None:
        """Add the windows that begin in the first ``STRETCH`` words of a stretch of a row to the ``best`` found there."""
        (low, high), (first, last) = stretch, text
        own = runs[low : high - size + 1]
        within = part[(part >= low) & (part < low + len(own))] - low
        if len(within):
            total = np.zeros((len(own) + 1, 64), np.int32)
            np.cumsum(signs(own), axis=0, out=total[1:])
            hit = np.zeros(len(own) + 1, np.int64)
            hit[within + 1] = 1
            hit = np.cumsum(hit)
            for n, length in enumerate(self.lengths):
                if length.size != size:
                    continue
                # a document shorter than the item is one window
                width = min(length.words, last - first) - size + 1
                starts = np.arange(0, min(STRETCH, len(own) - width + 1))
                starts = starts[hit[starts + width] > hit[starts]]
                if not len(starts):
                    continue
                which, item = length.within_radius(fingerprints(total[starts + width] - total[starts]))
                # no more shingles can be shared than stand in the window and are any item's
                shared, needed = hit[starts + width] - hit[starts], SIMILARITY / (1 + SIMILARITY) * (width + length.shingles)
                use = shared[which] >= needed - 1e-9
                which, item = which[use], item[use]
                for s, i in zip(starts[which].tolist(), item.tolist()):
                    window = Counter(own[s : s + width].tolist())
                    value = similarity(window, length.items[i].shingles)
                    if value >= SIMILARITY:
                        start = low + s - first
                        old = best.get((n, i))
                        if old is None or (-value, start) < (-old.similarity, old.start):
                            best[n, i] = Match(row, length.items[i].item_id, start, width + size - 1, value)


@lru_cache(maxsize=1)
def items_of(rows: tuple[tuple[int | None, bytes], ...]) -> Items:
    return Items(list(rows))


def item_blocks(benchmark: DataFrame, item_bytes: int = ITEM_BYTES) -> Iterator[tuple[tuple[int | None, bytes], ...]]:
    """The items, in blocks of about ``item_bytes`` of text; each item is in one."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), utf8("text").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, ceil(total / item_bytes))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n)))
    for block in range(n):
        found = rows.filter(F.col("_block") == block).distinct().collect()
        if found:
            yield tuple(sorted(((r["item_id"], bytes(r["text"])) for r in found), key=lambda r: (r[0] is not None, r[0] or 0, r[1])))


def leaks(docs: DataFrame, benchmark: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """doc_id, item_id, start, n_words, similarity: for each row of ``docs`` (doc_id, text) and each item of
    ``benchmark`` (item_id, text), the window most similar to the item if its similarity is 0.75 or more.

    ``start`` counts words from 0; the first of equally similar windows counts. Defined cases: null and
    empty texts and items match nothing; a document shorter than an item is one window; an item of fewer
    than five words matches where its words stand; repeated rows match as often as they occur, repeated
    items once; null ids stay null; extra columns are ignored.
    """

    def search(rows: tuple[tuple[int | None, bytes], ...]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = list(items_of(rows).matches(batch["text"]))
            doc = batch["doc_id"].take(pa.array([m.row for m in found], pa.int64()))
            rest = zip((1, 2, 3, 4), (pa.int64(), pa.int64(), pa.int64(), pa.float64()))
            names = ["doc_id", "item_id", "start", "n_words", "similarity"]
            return pa.RecordBatch.from_arrays([doc, *(pa.array([m[k] for m in found], kind) for k, kind in rest)], names)

        return work

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    schema = "doc_id long, item_id long, start long, n_words long, similarity double"
    parts = [by_batch(own, search(rows), schema) for rows in item_blocks(benchmark, item_bytes)]
    if not parts:
        return own.select("doc_id", *(F.lit(None).cast(t).alias(c) for c, t in (("item_id", "long"), ("start", "long"), ("n_words", "long"), ("similarity", "double")))).limit(0)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, item_bytes: int = ITEM_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns; cases as in ``leaks``."""

    def search(rows: tuple[tuple[int | None, bytes], ...]) -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            text = batch["text"].cast(pa.binary())
            found = {m.row for m in items_of(rows).matches(text)}
            return batch.filter(pa.array([i not in found for i in range(batch.num_rows)], pa.bool_()))

        return work

    for rows in item_blocks(benchmark, item_bytes):
        docs = by_batch(docs, search(rows), docs.schema)
    return docs
