"""Substring dedup: word windows that occur earlier in the corpus, found by level-wise doubling.

A window is ``window`` consecutive words of one document. Levels have windows of a quarter, half and
all of that length (lengths double). At a level, only windows whose shorter parts were found repeated
at the level before are still candidates; the loop ends at ``window`` words, as every longer repeat is
a union of windows of that length. Below the last level a candidate stands for itself by its *anchor*:
the least hash among its runs of the level's length. Equal windows have equal anchors, so a candidate
whose anchor occurs once is dropped without loss.

How it runs: documents are dealt to shards by a hash of id and text. At each level a shard sends every
distinct hash once, sorted, to the bucket that owns its range, so a window found in a third of all rows
costs one entry a shard. The bucket answers with one bit per entry, in the order it got them, and the
shard, which derives the same sorted entries again, reads off its bits. All levels read the same shuffle
of the texts. The last level compares 96-bit hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.jobs import SHARD_BYTES, release, shard_count
from ledgermill.llm.text import U64, chunks, inside, span_hashes

WINDOW = 20

TOP = np.iinfo(np.uint64).max
SENT = "bucket int, shard int, level int, hashes binary, extra binary"
TOLD = "shard int, level int, bucket int, bits binary"


def sliding(values: np.ndarray, n: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over every ``n`` consecutive values."""
    width = 1
    while 2 * width <= n:
        values = pick(values[:-width], values[width:]) if len(values) > width else values[:0]
        width *= 2
    rest = n - width
    return values if not rest else pick(values[:-rest], values[rest:]) if len(values) > rest else values[:0]


def levels(window: int) -> list[int]:
    return sorted({max(1, window // 4), max(1, window // 2), window})


class Shard:
    """The word hashes of a shard's documents, and which windows are still candidates."""

    def __init__(self, docs: pa.Table, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        hashes, checks, first = [], [], [np.zeros(1, np.int64)]
        for texts in chunks(docs["text"]):
            words = texts.words()
            hashes.append(words.hashes(1))
            checks.append(words.hashes(2))
            first.append(words.first[1:] + first[-1][-1])
        self.first = np.concatenate(first)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, U64)
        self.checks = np.concatenate(checks) if checks else np.zeros(0, U64)
        ids = docs["doc_id"].combine_chunks()
        # a null id comes before all others
        self.doc_ids = np.asarray(ids.fill_null(np.iinfo(np.int64).min), dtype=np.int64)
        self.tied = "tie" in docs.column_names
        self.ties = np.asarray(docs["tie"].combine_chunks(), dtype=np.int64) if self.tied else np.zeros(len(self.doc_ids), np.int64)
        self.candidate = inside(self.first, window)

    def edges(self, hashes: np.ndarray) -> np.ndarray:
        """Where each bucket's range begins in sorted hashes, and the end."""
        shift = U64(32)
        owner = ((hashes >> shift) * U64(self.buckets)) >> shift
        return np.searchsorted(owner, np.arange(self.buckets + 1, dtype=U64))

    def anchors(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The candidates' anchors: of every window, and the distinct ones with whether they occur here twice."""
        runs = span_hashes(self.hashes, length)
        width = self.window - length + 1
        least = sliding(runs, width, np.minimum)
        least = np.where(self.candidate, least, U64(0))
        padded = np.zeros(len(runs) + width - 1, U64)
        padded[width - 1 : width - 1 + len(least)] = least
        at = sliding(padded, width, np.maximum) == runs
        distinct, count = np.unique(runs[at & (runs > 0)], return_counts=True)
        return least, distinct, count > 1

    def narrow(self, length: int, told: dict[int, bytes]) -> None:
        """Keep the candidates whose anchor is repeated, here or by the buckets' answers."""
        least, distinct, twice = self.anchors(length)
        repeated = distinct[twice | self.bits(distinct, told)]
        if not len(repeated):
            self.candidate[:] = False
            return
        # a window often has its neighbour's anchor: look each run of equal ones up once
        head = np.ones(len(least), bool)
        head[1:] = least[1:] != least[:-1]
        value = least[head]
        place = np.minimum(np.searchsorted(repeated, value), len(repeated) - 1)
        self.candidate &= (repeated[place] == value)[np.cumsum(head) - 1]

    def bits(self, hashes: np.ndarray, told: dict[int, bytes]) -> np.ndarray:
        edges = self.edges(hashes)
        out = np.zeros(len(hashes), bool)
        for bucket, bits in told.items():
            a, b = edges[bucket], edges[bucket + 1]
            out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a)
        return out

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The candidate windows: first word, row; distinct 96-bit hashes in order; which one each has."""
        start = np.flatnonzero(self.candidate)
        row = np.searchsorted(self.first, start, "right") - 1
        high = span_hashes(self.hashes, self.window)[start] if len(start) else np.zeros(0, U64)
        low = (span_hashes(self.checks, self.window)[start] if len(start) else np.zeros(0, U64)) >> U64(32)
        order = np.lexsort((low, high))
        new = np.ones(len(order), bool)
        h, c = high[order], low[order]
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        return start, row, h[new], c[new].astype(np.uint32), which

    def least_row(self, row: np.ndarray, which: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Id and tie of the first row of each distinct window."""
        order = np.lexsort((self.ties[row], self.doc_ids[row], which))
        first = np.ones(len(order), bool)
        first[1:] = which[order][1:] != which[order][:-1]
        least = row[order[first]]
        return self.doc_ids[least], self.ties[least]

    def removed(self, told: dict[int, bytes]) -> np.ndarray:
        """Per word: whether a window that starts earlier somewhere covers it."""
        start, row, hashes, _, which = self.windows()
        least, tie = (v[which] for v in self.least_row(row, which, len(hashes)))
        own = self.doc_ids[row]
        later = self.bits(hashes, told)[which] | (own > least) | ((own == least) & (self.ties[row] > tie))
        order = np.lexsort((start, row, which))  # the same window again in one row
        again = np.zeros(len(order), bool)
        again[1:] = (which[order][1:] == which[order][:-1]) & (row[order][1:] == row[order][:-1])
        later[order] |= again
        change = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(change, start[later], 1)
        np.add.at(change, start[later] + self.window, -1)
        return np.cumsum(change[:-1]) > 0

    def sent(self, shard: int, length: int) -> pa.Table:
        rows = []
        if length < self.window:
            _, hashes, extra = self.anchors(length)
        else:
            _, row, hashes, low, which = self.windows()
            extra, ties = self.least_row(row, which, len(hashes))
        edges = self.edges(hashes)
        for bucket in np.flatnonzero(np.diff(edges)):
            a, b = edges[bucket], edges[bucket + 1]
            if length < self.window:
                more = np.packbits(extra[a:b]).tobytes()
            else:
                more = low[a:b].tobytes() + extra[a:b].tobytes() + (ties[a:b].tobytes() if self.tied else b"")
            rows.append((int(bucket), shard, length, hashes[a:b].tobytes(), more))
        return table(rows, SENT_ARROW)


SENT_ARROW = pa.schema([("bucket", pa.int32()), ("shard", pa.int32()), ("level", pa.int32()), ("hashes", pa.binary()), ("extra", pa.binary())])
TOLD_ARROW = pa.schema([("shard", pa.int32()), ("level", pa.int32()), ("bucket", pa.int32()), ("bits", pa.binary())])


def table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema)


def answer(sent: pa.Table, window: int, tied: bool) -> pa.Table:
    """A bucket's answers: below the last level whether other shards have the hash; there, whether an earlier row has."""
    rows = sent.to_pylist()
    if not rows:
        return table([], TOLD_ARROW)
    hashes = [np.frombuffer(r["hashes"], U64) for r in rows]
    ends = np.cumsum([len(h) for h in hashes])
    every = np.concatenate(hashes)
    bucket, level = rows[0]["bucket"], rows[0]["level"]
    if level < window:
        order = np.argsort(every, kind="stable")
        same = every[order][1:] == every[order][:-1]
        yes = np.zeros(len(every), bool)
        yes[order[1:]] |= same
        yes[order[:-1]] |= same
    else:
        n = [len(h) for h in hashes]
        low = np.concatenate([np.frombuffer(r["extra"], np.uint32, k) for r, k in zip(rows, n)])
        doc = np.concatenate([np.frombuffer(r["extra"], np.int64, k, 4 * k) for r, k in zip(rows, n)])
        tie = np.concatenate([np.frombuffer(r["extra"], np.int64, k, 12 * k) for r, k in zip(rows, n)]) if tied else np.zeros(len(every), np.int64)
        order = np.lexsort((tie, doc, low, every))
        h, c = every[order], low[order]
        new = np.ones(len(order), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        least, first = (v[order][np.flatnonzero(new)][np.cumsum(new) - 1] for v in (doc, tie))
        yes = np.empty(len(order), bool)
        yes[order] = (doc[order] > least) | ((doc[order] == least) & (tie[order] > first))
    pieces = np.split(yes, ends[:-1])
    return table([(r["shard"], level, bucket, np.packbits(p).tobytes()) for r, p in zip(rows, pieces)], TOLD_ARROW)


def told_by_level(told: pa.Table) -> dict[int, dict[int, bytes]]:
    out: dict[int, dict[int, bytes]] = {}
    for r in told.to_pylist():
        out.setdefault(r["level"], {})[r["bucket"]] = r["bits"]
    return out


def results(docs: pa.Table, removed: np.ndarray, first: np.ndarray, edited: bool) -> pa.Table:
    """Counts and kept words of each row; with ``edited`` the text itself, unchanged where nothing went."""
    gone = np.concatenate([[0], np.cumsum(removed)])
    kept_text, digests = [], []
    for i, raw in enumerate(docs["text"].to_pylist()):
        a, b = first[i], first[i + 1]
        words = (raw or b"").split()
        if gone[b] > gone[a]:
            words = [words[k] for k in np.flatnonzero(~removed[a:b])]
        kept = b" ".join(words)
        digests.append(hashlib.sha256(kept).hexdigest())
        if edited:
            kept_text.append(kept if gone[b] > gone[a] else raw)
    out = {
        "doc_id": docs["doc_id"],
        "n_words": pa.array(np.diff(first), pa.int64()),
        "n_removed": pa.array(gone[first[1:]] - gone[first[:-1]], pa.int64()),
        "kept_sha256": pa.array(digests, pa.string()),
    }
    if edited:
        out["kept_text"] = pa.array(kept_text, pa.binary())
        out["carried"] = docs["carried"]
    return pa.table(out)


def substring_dedup(
    docs: DataFrame,
    window: int = WINDOW,
    carry: list[str] | None = None,
    shard_bytes: int = SHARD_BYTES,
    tie: Column | None = None,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row of ``docs`` (doc_id, text).

    A word goes if a window covers it whose word sequence also starts earlier: in a document of smaller
    id, or earlier in the same document. Windows are judged on the input. With ``carry``, the columns
    named come back as the struct ``carried`` and the text as ``kept_text``: the kept words joined by one
    space, or the text as it was if none went.

    Defined cases: a null text has no words and stays null; a text of fewer than ``window`` words loses
    none; a null id counts as the smallest. Rows with one id do not remove each other's words, so
    repeated rows all get the same result; with ``tie``, a number, rows of one id come one after the other
    by it, and only rows of one number too do not. Extra columns are ignored. No rows give no rows.
    """
    n = shard_count(docs, "text", shard_bytes)
    shard = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text")), F.lit(n)).cast("int")
    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text")]
    if carry is not None:
        carried = [F.col(f"`{c}`") for c in carry] or [F.lit(None).cast("int").alias("nothing")]
        columns.append(F.struct(*carried).alias("carried"))
    tied = tie is not None
    if tied:
        columns.append(tie.cast("long").alias("tie"))
    sharded = docs.select(shard.alias("shard"), *columns).repartition(n, "shard")

    def narrowed(part: pa.Table, told: pa.Table, length: int) -> Shard:
        own, answers = Shard(part, window, n), told_by_level(told)
        for earlier in lengths[: lengths.index(length)]:
            own.narrow(earlier, answers.get(earlier, {}))
        return own

    def begin(key, part):
        release()
        sent = Shard(part, window, n).sent(key[0].as_py(), lengths[0])
        release()
        return sent

    def at(length: int):
        def send(key, part, told):
            sent = narrowed(part, told, length).sent(key[0].as_py(), length)
            release()
            return sent

        return send

    def judged(part: pa.Table) -> pa.Table:
        made = answer(part, window, tied)
        release()
        return made

    lengths, answers = levels(window), None
    for length in lengths:
        if answers is None:
            sent = sharded.groupBy("shard").applyInArrow(begin, SENT)
        else:
            sent = sharded.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(at(length), SENT)
        told = sent.repartition(n, "bucket").groupBy("bucket", "level").applyInArrow(judged, TOLD)
        answers = (told if answers is None else answers.unionByName(told)).repartition(n, "shard")

    def finish(part: pa.Table, told: pa.Table) -> pa.Table:
        own = narrowed(part, told, window)
        done = results(part, own.removed(told_by_level(told).get(window, {})), own.first, carry is not None)
        release()
        return done

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if carry is not None:
        schema += f", kept_text binary, carried {sharded.schema['carried'].dataType.simpleString()}"
    return sharded.groupBy("shard").cogroup(answers.groupBy("shard")).applyInArrow(finish, schema)
