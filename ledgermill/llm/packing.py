"""Best-fit packing by length histogram.

Documents are cut into pieces of at most ``cap`` ids. How many pieces there are of each length, at most
``cap`` numbers, is all the plan needs: lengths from long to short, each into the fullest sequences that
still have room, as many sequences at a time as share a state. The plan says for every length which ranks
go to which sequences; a piece then finds its slot by its rank among the pieces of its length. Ranks come
from counts per (length, task), so no length's pieces are gathered, however many share one.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.jobs import by_batch, checkpointed
from ledgermill.llm.tokens import encoder

CAP = 1024


class Run(NamedTuple):
    """Pieces of one length, ranks ``rank`` to ``rank + n``, ``each`` to a sequence from ``sequence`` on, side by side from ``offset``."""

    rank: int
    n: int
    each: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], cap: int = CAP) -> tuple[dict[int, list[Run]], int]:
    """Runs of every length, and the number of sequences."""
    rooms: list[list[tuple[int, int]]] = [[] for _ in range(cap + 1)]  # by free room: first sequence, how many
    runs: dict[int, list[Run]] = {}
    sequences = 0
    for length in sorted(counts, reverse=True):
        own, rank, left = runs.setdefault(length, []), 0, counts[length]
        while left:
            room = next((r for r in range(length, cap + 1) if rooms[r]), None)
            if room is None:
                room, first, many = cap, sequences, -(-left // (cap // length))
                sequences += many
            else:
                first, many = rooms[room].pop()
            each = room // length
            full = min(many, left // each)
            if full:
                own.append(Run(rank, full * each, each, first, cap - room))
                rooms[room - each * length].append((first, full))
                rank, left, first, many = rank + full * each, left - full * each, first + full, many - full
            if left and many:  # fewer than ``each`` are left: they share the next sequence
                own.append(Run(rank, left, left, first, cap - room))
                rooms[room - left * length].append((first, 1))
                left, first, many = 0, first + 1, many - 1
            if many:
                rooms[room].append((first, many))
        rooms[0].clear()
    return runs, sequences


def pieces(docs: DataFrame, tokenizer: str, end_id: int, cap: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; part and rank: its task, and its rank in its length there."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, end = encoder(tokenizer).each, np.array([end_id], np.uint32)
        part, seen = TaskContext.get().partitionId(), [0] * (cap + 1)
        for batch in batches:
            rows = []
            for doc_id, found in zip(batch["doc_id"].to_pylist(), encode_texts(batch["text"].to_pylist())):
                ids = np.concatenate([found, end])
                raw = memoryview(ids.astype("<u4").tobytes())
                stops = range(len(ids) % cap or cap, len(ids) + 1, cap)
                start = 0
                for piece, stop in enumerate(stops):
                    rows.append((doc_id, piece, start, stop - start, zlib.crc32(raw[4 * start : 4 * stop]), part, seen[stop - start]))
                    seen[stop - start] += 1
                    start = stop
            columns = list(zip(*rows)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8(F.col("text").cast("string")).alias("text"))
    return own.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, rank long")


def best_fit_packing(docs: DataFrame, tokenizer: str, end_id: int, cap: int = CAP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs`` (doc_id, text).

    A document's ids, then ``end_id``; only documents of more than ``cap`` are cut, the first piece taking
    what is left over. Defined cases: a null or empty text is its end id alone; rows with one id, and
    repeated rows, are documents of their own; null ids stay null; extra columns are ignored; no rows give
    no rows. Which of several pieces of one length gets which slot is arbitrary.
    """
    cut = checkpointed(pieces(docs, tokenizer, end_id, cap))
    counts = cut.groupBy("length", "part").agg(F.count("*").alias("n"))
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = plan(totals, cap)
    starts = {length: [r.rank for r in own] for length, own in runs.items()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        sequence, offset = [], []
        for length, rank in zip(batch["length"].to_pylist(), batch["rank"].to_pylist()):
            run = runs[length][bisect_right(starts[length], rank) - 1]
            sequence.append(run.sequence + (rank - run.rank) // run.each)
            offset.append(run.offset + (rank - run.rank) % run.each * length)
        kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.RecordBatch.from_arrays([*(batch[c] for c in kept), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*kept, "sequence_id", "offset"])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return by_batch(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), place, schema)
