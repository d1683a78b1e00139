"""LM scoring: a hashed maximum-entropy model with a class-factored softmax.

A word's class is a hash of its last two bytes, so it is known for every word, seen or not; the end of a
text is a class of its own. p(word | history) = p(class | history) * p(word | class).

- p(class | history) is a softmax over the classes. Its features are hashed: the word before, the two words
  before together, and two skips, the word two and the word three before. Each feature has a row of weights,
  one a class, in a table of ``ROWS`` rows.
- p(word | class) comes from the counts of all training tokens, with one added to each.

Training: one epoch in ``ROUNDS`` rounds, in which every training document is used once. In a round every
task runs over its documents with mini-batch gradient steps (AdaGrad) from the round's weights; what it
changed in a row counts by how often it met the row, and the sums give the next round's weights.

Counts: each task counts its words before the shuffle, and buckets of the hash range add them up. For
scoring, documents are dealt to shards; a shard asks each bucket once for the distinct words it has there
and gets their counts in the same order. Nothing of the vocabulary reaches the driver but totals per class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.jobs import SHARD_BYTES, checkpointed, remainder, shard_count, utf8
from ledgermill.llm.text import U64, Texts, chunks, mix, random_words

CLASSES = 32
ROWS = 1 << 13
ROUNDS = 2
BATCH = 1 << 14
RATE = 0.3
HELD_OUT = (7, 2)

END, START = random_words(21, 2)
END_CLASS = CLASSES - 1
KINDS = (mix(random_words(22, 1 << 16)) % U64(CLASSES - 1)).astype(np.uint8)
SALTS = random_words(23, 4)

COUNT_TOKENS = 1 << 22
"""Tokens a task counts before it passes the counts on."""

COUNTS = "bucket int, hashes binary, counts binary, classes binary"


class Stream:
    """The tokens of some texts: words, then one end each."""

    def __init__(self, texts: Texts):
        words = texts.words(fold=True)
        n = len(texts)
        self.sizes = words.counts() + 1
        self.first = np.concatenate([[0], np.cumsum(self.sizes)])
        self.tokens = np.empty(self.first[-1], U64)
        self.classes = np.empty(self.first[-1], np.uint8)
        text = np.repeat(np.arange(n), words.counts())
        at = np.arange(len(text)) + text
        self.tokens[at] = words.hashes()
        data = texts.data
        last = data[words.end - 1].astype(np.int64)
        before = np.where(words.end - words.start > 1, data[np.maximum(words.end - 2, 0)], 0).astype(np.int64)
        for letter in (last, before):
            letter[(letter >= 65) & (letter <= 90)] += 32
        self.classes[at] = KINDS[before * 256 + last]
        ends = self.first[1:] - 1
        self.tokens[ends], self.classes[ends] = END, END_CLASS
        self.text = np.repeat(np.arange(n), self.sizes)
        self.place = np.arange(self.first[-1]) - self.first[:-1][self.text]

    def back(self, n: int) -> np.ndarray:
        """The token ``n`` before each, or the start."""
        out = np.full(len(self.tokens), START, U64)
        out[n:] = self.tokens[: len(self.tokens) - n] if n < len(self.tokens) else out[n:]
        out[self.place < n] = START
        return out

    def features(self) -> np.ndarray:
        """A row of the weights' table for each token and feature."""
        one, two, three = self.back(1), self.back(2), self.back(3)
        rows = (one ^ SALTS[0], mix(one) + two ^ SALTS[1], two ^ SALTS[2], three ^ SALTS[3])
        return np.stack([(mix(r) >> U64(64 - 13)).astype(np.uint16) for r in rows], 1)


assert ROWS == 1 << 13


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # ROWS x CLASSES
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def train_tokens(self) -> int:
        return int(self.class_tokens.sum())

    @property
    def train_words(self) -> int:
        return int(self.class_words.sum())


def log_softmax(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    z = weights[features[:, 0]]
    for k in range(1, features.shape[1]):
        z += weights[features[:, k]]
    z -= z.max(1, keepdims=True)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return z


def row_sums(features: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The rows met, the sum of ``values`` over each, and how often it was met."""
    order = np.argsort(features, kind="stable")
    rows = features[order]
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    return rows[starts], np.add.reduceat(values[order], starts, axis=0), np.diff(np.append(starts, len(rows)))


class Trainer:
    """Gradient steps of one task."""

    def __init__(self, weights: np.ndarray):
        self.start, self.weights = weights, weights.copy()
        self.squares = np.full(weights.shape, 1e-2, np.float32)
        self.met = np.zeros(len(weights), np.int64)

    def steps(self, stream: Stream, use: np.ndarray) -> None:
        features, classes = stream.features()[use], stream.classes[use]
        for a in range(0, len(classes), BATCH):
            f, c = features[a : a + BATCH], classes[a : a + BATCH]
            g = np.exp(log_softmax(self.weights, f))
            g[np.arange(len(c)), c] -= 1
            for k in range(f.shape[1]):
                rows, sums, met = row_sums(f[:, k], g)
                self.squares[rows] += sums * sums
                self.weights[rows] -= np.float32(RATE) * sums / np.sqrt(self.squares[rows])
                self.met[rows] += met

    def changes(self) -> pa.RecordBatch:
        rows = np.flatnonzero(self.met)
        met = self.met[rows].astype(np.float64)
        moved = (self.weights[rows] - self.start[rows]) * met[:, None]
        columns = [pa.array(rows, pa.int32()), pa.array(met), *(pa.array(moved[:, c], pa.float64()) for c in range(moved.shape[1]))]
        return pa.RecordBatch.from_arrays(columns, ["row", "met", *(f"c{c}" for c in range(moved.shape[1]))])


def train_round(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Weights after one round over ``rows`` (text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(weights)
        for batch in batches:
            for texts in chunks(batch["text"]):
                stream = Stream(texts)
                trainer.steps(stream, np.arange(len(stream.tokens)))
        yield trainer.changes()

    names = [f"c{c}" for c in range(CLASSES)]
    changes = rows.select("text").mapInArrow(run, "row int, met double, " + ", ".join(f"{n} double" for n in names))
    sums = changes.groupBy("row").agg(F.sum("met").alias("met"), *(F.sum(n).alias(n) for n in names)).collect()
    after = weights.copy()
    for r in sums:
        after[r["row"]] += np.array([r[n] for n in names], np.float32) / np.float32(r["met"])
    return after


def owners(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range begins in sorted hashes, and the end."""
    owner = ((hashes >> U64(32)) * U64(buckets)) >> U64(32)
    return np.searchsorted(owner, np.arange(buckets + 1, dtype=U64))


def counted(tokens: np.ndarray, classes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens in order, how often each occurs, and its class."""
    order = np.argsort(tokens, kind="stable")
    rows = tokens[order]
    starts = np.flatnonzero(np.append(True, rows[1:] != rows[:-1])) if len(rows) else np.zeros(0, np.int64)
    if counts is None:
        sums = np.diff(np.append(starts, len(rows)))
    else:
        sums = np.add.reduceat(counts[order], starts) if len(rows) else counts
    return rows[starts], sums.astype(np.int64), classes[order][starts]


def vocabulary(rows: DataFrame, buckets: int) -> DataFrame:
    """Counts of all tokens of ``rows`` (text), a row for each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Stream] = []

        def flush() -> pa.RecordBatch:
            tokens, counts, classes = counted(np.concatenate([s.tokens for s in held]), np.concatenate([s.classes for s in held]))
            held.clear()
            edges = owners(tokens, buckets)
            own = [(b, edges[b], edges[b + 1]) for b in range(buckets) if edges[b + 1] > edges[b]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([b for b, _, _ in own], pa.int32()),
                    pa.array([tokens[x:y].tobytes() for _, x, y in own], pa.binary()),
                    pa.array([counts[x:y].astype(np.uint32).tobytes() for _, x, y in own], pa.binary()),
                    pa.array([classes[x:y].tobytes() for _, x, y in own], pa.binary()),
                ],
                ["bucket", "hashes", "counts", "classes"],
            )

        for batch in batches:
            for texts in chunks(batch["text"]):
                held.append(Stream(texts))
                if sum(len(s.tokens) for s in held) >= COUNT_TOKENS:
                    yield flush()
        if held:
            yield flush()

    def add(part):
        hashes = np.frombuffer(b"".join(part["hashes"].to_pylist()), U64)
        counts = np.frombuffer(b"".join(part["counts"].to_pylist()), np.uint32).astype(np.int64)
        classes = np.frombuffer(b"".join(part["classes"].to_pylist()), np.uint8)
        tokens, sums, kinds = counted(hashes, classes, counts)
        of = lambda w: np.bincount(kinds, w, CLASSES).astype(np.int64).tolist()
        values = (part["bucket"][0].as_py(), tokens.tobytes(), sums.tobytes(), of(sums), of(None))
        kinds_of = (pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds_of)], ["bucket", "hashes", "counts", "class_tokens", "class_words"])

    local = rows.select("text").mapInArrow(count, COUNTS).repartition(buckets, "bucket")
    return local.groupBy("bucket").applyInArrow(add, "bucket int, hashes binary, counts binary, class_tokens array<long>, class_words array<long>")


def class_totals(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros((2, CLASSES), np.int64)
    for k, column in enumerate(("class_tokens", "class_words")):
        rows = words.select(F.posexplode(column).alias("c", "n")).groupBy("c").agg(F.sum("n").alias("n")).collect()
        for r in rows:
            out[k, r["c"]] = r["n"]
    return out[0], out[1]


def learn(docs: DataFrame, buckets: int) -> tuple[Model, DataFrame]:
    """The model, and the counted words, from the rows outside the held-out fold."""
    rows = docs.filter(remainder("doc_id", HELD_OUT[0]) != HELD_OUT[1])
    words = checkpointed(vocabulary(rows, buckets))
    weights = np.zeros((ROWS, CLASSES), np.float32)
    for turn in range(ROUNDS):
        weights = train_round(rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS)) == turn), weights)
    return Model(weights, *class_totals(words)), words


class Shard:
    """The tokens of a shard's documents, and the distinct ones in order."""

    def __init__(self, docs: pa.Table, buckets: int):
        self.streams = [Stream(t) for t in chunks(docs["text"])]
        every = np.concatenate([s.tokens for s in self.streams])
        self.distinct = np.unique(every)
        self.edges = owners(self.distinct, buckets)

    def asked(self, shard: int) -> pa.Table:
        own = np.flatnonzero(np.diff(self.edges))
        hashes = [self.distinct[self.edges[b] : self.edges[b + 1]].tobytes() for b in own]
        return pa.table(
            [pa.array(own, pa.int32()), pa.array([shard] * len(own), pa.int32()), pa.array(hashes, pa.binary())], ["bucket", "shard", "hashes"]
        )

    def scores(self, told: pa.Table, model: Model) -> list[np.ndarray]:
        """n_tokens, n_known, base_score and score of every document."""
        counts = np.zeros(len(self.distinct), np.int64)
        for bucket, found in zip(told["bucket"].to_pylist(), told["counts"].to_pylist()):
            counts[self.edges[bucket] : self.edges[bucket + 1]] = np.frombuffer(found, np.int64)
        base = np.log10(model.train_tokens + model.train_words + 1)
        within = np.log10(model.class_tokens + model.class_words + 1)
        parts = []
        for s in self.streams:
            c = counts[np.searchsorted(self.distinct, s.tokens)]
            seen = np.log10(c + 1)
            features, value = s.features(), np.empty(len(c))
            for a in range(0, len(c), BATCH):
                f, k = features[a : a + BATCH], s.classes[a : a + BATCH]
                value[a : a + BATCH] = log_softmax(model.weights, f)[np.arange(len(k)), k] / np.log(10)
            value += seen - within[s.classes]
            starts = s.first[:-1]
            parts.append([s.sizes, *(np.add.reduceat(v, starts) for v in ((c > 0).astype(np.int64), seen - base, value))])
        return [np.concatenate(p) for p in zip(*parts)]


def language_model(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    Learned from the rows outside the fold that ``held_out`` marks. Words are told apart by 64-bit hashes.
    Defined cases: a null or empty text is its end token alone; with nothing to learn from, every count is
    0, ``base_score`` is 0 and all classes are equally likely; rows with one id, and repeated rows, count as
    often as they occur; a null id belongs to the fold of the text "null"; extra columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    n = shard_count(docs, "text", shard_bytes)
    model, words = learn(own, n)
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int").alias("shard")
    sharded = own.select(shard, "doc_id", (remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1]).alias("held_out"), "text").repartition(n, "shard")

    def ask(key, part):
        return Shard(part, n).asked(key[0].as_py())

    def reply(asked: pa.Table, known: pa.Table) -> pa.Table:
        bucket = asked["bucket"].to_pylist()
        hashes = np.frombuffer(b"".join(known["hashes"].to_pylist()), U64)
        counts = np.append(np.frombuffer(b"".join(known["counts"].to_pylist()), np.int64), 0)
        found = []
        for raw in asked["hashes"].to_pylist():
            own = np.frombuffer(raw, U64)
            at = np.searchsorted(hashes, own)
            there = np.append(hashes, U64(0))[at] == own if len(hashes) else np.zeros(len(own), bool)
            found.append(np.where(there & (at < len(hashes)), counts[at], 0).astype(np.int64).tobytes())
        return pa.table([asked["shard"], pa.array(bucket, pa.int32()), pa.array(found, pa.binary())], ["shard", "bucket", "counts"])

    def score(part: pa.Table, told: pa.Table) -> pa.Table:
        sizes, known, base, value = Shard(part, n).scores(told, model)
        total = pa.array([model.train_tokens] * part.num_rows, pa.int64())
        columns = [part["doc_id"], part["held_out"], pa.array(sizes, pa.int64()), pa.array(known, pa.int64()), total, pa.array(base), pa.array(value)]
        return pa.table(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    asked = sharded.groupBy("shard").applyInArrow(ask, "bucket int, shard int, hashes binary").repartition(n, "bucket")
    vocabulary_rows = words.select("bucket", "hashes", "counts").repartition(n, "bucket")
    told = asked.groupBy("bucket").cogroup(vocabulary_rows.groupBy("bucket")).applyInArrow(reply, "shard int, bucket int, counts binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return sharded.groupBy("shard").cogroup(told.repartition(n, "shard").groupBy("shard")).applyInArrow(score, schema)
