"""MinHash near-dedup by a multi-index Hamming join of b-bit signatures.

A signature has ``SLOTS`` values of 16 bits, the least hashes of a document's shingles under as many hash
functions. It is cut into ``CHUNKS`` chunks of ``WIDTH`` slots. If two signatures differ in no more than
``RADIUS`` slots, some chunk differs in at most ``ERRORS`` slots (pigeonhole: else they would differ in
``CHUNKS * (ERRORS + 1)``). So for each chunk every way of leaving out ``ERRORS`` slots gives a key, and all
pairs within the radius share a key. Two documents of similarity 0.75 are beyond the radius once in 6,000
cases, of 0.8 once in 300,000. Links are then confirmed on the full shingle sets.

Pairs are never listed. Documents of equal sets are one class, whose smallest id stands for it. Every key
has a center, the document whose keys are the most shared; the documents of all keys with one center are a
cell, so two documents that share a key share a cell. A copied original tends to be the center, and linking
every document to its centers joins most copies at once. What is left are cells whose documents lie in
several components: there signatures are held against each other, and documents within the radius of one in
another component are compared on their full sets, block by block if the cell is large. A block gives links
that span what it found connected, not all links. That finds the same components as all pairs would.

A key that a task finds in several documents of a batch is sent on once and its documents are dealt by id,
so a key that a third of all rows have loads no task more than others.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.jobs import by_batch, checkpointed, releasing, unused
from ledgermill.llm.similar import (
    across,
    by_place,
    centers,
    classes_of,
    fingerprint,
    first_rows,
    links_at,
    members_of,
    mixed_cells,
    placed,
    places,
    row_components,
    sent_on,
    shingles,
    similar_sizes,
    star_places,
    tagged,
)
from ledgermill.llm.text import U64, mix, random_words
from ledgermill.operators.skew import spread_join

PERCENT = 75

CHUNKS, WIDTH, ERRORS = 8, 6, 2
SLOTS = CHUNKS * WIDTH
RADIUS = CHUNKS * (ERRORS + 1) - 1

KEPT_SLOTS = np.array(list(combinations(range(WIDTH), WIDTH - ERRORS)))

SIGNATURE_BLOCK, TEXT_BLOCK = 1_000, 250
"""Documents of one cell whose signatures, and whose texts, are compared in one place; of more, every two blocks are."""

ROWS = "doc_id long, tag long, n_shingles long, left long, right long, signature binary"

WORD = r"[^\x20\x09-\x0D]"

MOST_KEPT = 1_000_000
"""Up to so many rows that stay (24 bytes each) are broadcast; beyond, all rows are joined by a shuffle."""


def hash_functions(n: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    return random_words(11, n) | U64(1), random_words(12, n)


def signature(sets: list[np.ndarray], factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of 16-bit values for each set; empty sets must not be asked for."""
    every = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    out = np.empty((len(sets), len(factors)), np.uint16)
    for k, (a, b) in enumerate(zip(factors, offsets)):
        out[:, k] = mix(np.minimum.reduceat(every * a + b, starts)) & U64(0xFFFF)
    return out


def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
    """doc_id, tag, n_shingles, a 128-bit fingerprint of the set, and its signature (null for an empty set)."""
    factors, offsets = hash_functions()
    counts, left, right, signatures = [], [], [], []
    held: list[np.ndarray] = []

    def flush() -> None:
        filled = [s for s in held if len(s)]
        made = iter(signature(filled, factors, offsets)) if filled else iter(())
        for s in held:
            counts.append(len(s))
            own = fingerprint(s)
            left.append(own[0])
            right.append(own[1])
            signatures.append(next(made).tobytes() if len(s) else None)
        held.clear()

    size = 0
    for s in shingles(batch["text"]):
        held.append(s)
        size += len(s)
        if size > 1 << 17:
            flush()
            size = 0
    flush()
    made = [*(pa.array(c, pa.int64()) for c in (counts, left, right)), pa.array(signatures, pa.binary())]
    return pa.RecordBatch.from_arrays([batch["doc_id"], batch["tag"], *made], ["doc_id", "tag", "n_shingles", "left", "right", "signature"])


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """All keys of each signature: the slots kept of each chunk, with the chunk and which slots they are."""
    parts = signatures.reshape(-1, CHUNKS, WIDTH)[:, :, KEPT_SLOTS].astype(U64)
    packed = parts[..., 0]
    for k in range(1, WIDTH - ERRORS):
        packed = (packed << U64(16)) | parts[..., k]
    kinds = random_words(13, CHUNKS * len(KEPT_SLOTS)).reshape(CHUNKS, -1)
    return mix(packed ^ kinds).reshape(len(signatures), -1)


def local_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """key, doc_id, shared: each signature's keys; see ``sent_on``."""
    rows = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.uint16).reshape(-1, SLOTS)
    return sent_on(chunk_keys(rows).ravel(), np.repeat(np.asarray(batch["doc_id"]), CHUNKS * len(KEPT_SLOTS)))


def near_across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """center, doc_id of documents within the radius of one of the same cell in another component."""
    for rows in places(batches, ["doc_id", "component", "own", "signature"]):
        doc, label, own = (rows[c].to_numpy() for c in ("doc_id", "component", "own"))
        sig = np.frombuffer(b"".join(rows["signature"].to_pylist()), np.uint16).reshape(-1, SLOTS)
        use = across(label, own)
        near = np.zeros(len(doc), bool)
        for i in np.flatnonzero(use.any(1)):
            near[i] = ((sig[use[i]] != sig[i]).sum(1) <= RADIUS).any()
        if near.any():
            yield pa.RecordBatch.from_arrays([rows["center"].combine_chunks().filter(pa.array(near)), pa.array(doc[near])], ["center", "doc_id"])


def within_radius(pairs: DataFrame, signatures: DataFrame) -> DataFrame:
    sig = lambda c: signatures.select(F.col("doc_id").alias(c), F.col("signature").alias(f"signature_{c}"), F.col("n_shingles").alias(f"n_{c}"))

    def near(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint16).reshape(-1, SLOTS) for c in ("signature_a", "signature_b"))
        keep = pa.array((x != y).sum(1) <= RADIUS)
        return pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep)], ["a", "b"])

    rows = spread_join(pairs.join(sig("b"), "b"), sig("a"), "a", ["b"]).filter(similar_sizes("n_a", "n_b", PERCENT))
    return by_batch(rows.select("a", "b", "signature_a", "signature_b"), near, "a long, b long")


def class_links(classes: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: links between ``classes`` (doc_id: their number, signature) that connect all that are connected."""
    members = members_of(classes.select("doc_id", "signature"), local_keys)
    signatures = classes.select("doc_id", "n_shingles", "signature")
    cells = centers(members)
    stars = checkpointed(cells.filter("center <> doc_id").select(F.col("center").alias("a"), F.col("doc_id").alias("b")))
    stars = checkpointed(within_radius(stars, signatures))
    links = links_at(star_places(stars, TEXT_BLOCK), classes, texts, PERCENT)
    own = mixed_cells(cells, links)
    near = by_place(placed(own.join(signatures.drop("n_shingles"), "doc_id"), SIGNATURE_BLOCK))
    near = near.mapInArrow(releasing(near_across), "center long, doc_id long").distinct()
    near = checkpointed(own.join(near, ["center", "doc_id"]))
    return links.union(links_at(placed(near, TEXT_BLOCK), classes, texts, PERCENT))


def sketched(docs: DataFrame, tag: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The texts (doc_id, tag, text), a row without text for each (n_shingles, left, right), and the classes of equal sets."""
    texts = tagged(docs, tag)
    rows = checkpointed(by_batch(texts, sketch, ROWS))
    return texts, rows, classes_of(rows, rows, "signature")


def minhash_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    Documents are linked if 100 * intersection >= 75 * union of their sets of five-word shingles;
    ``component_id`` is the smallest id that links reach, ``kept`` whether it is the row's own.
    Defined cases: a null or empty text has an empty set and no links; a text of fewer than five words is
    one shingle; rows with one id are one document, linked if any of them is, and all get its component;
    a row without an id has no links, no component (null) and is kept. Extra columns are ignored.
    """
    texts, rows, classes = sketched(docs.filter("doc_id is not null"))
    found = row_components(rows, classes, class_links(classes, texts))
    kept = found.withColumn("kept", F.col("component_id") == F.col("doc_id"))
    without = by_batch(tagged(docs.filter("doc_id is null")), sketch, ROWS)
    return kept.unionByName(
        without.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    )


def first_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay if of each group of near copies one does: all columns, as they are.

    The row of smallest id stays, a null id being the smallest; of one id, the row of smallest hash; of equal
    rows, one. Rows of one id are documents of their own here. A row without words is in no group and stays.
    """
    tag = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    texts, rows, classes = sketched(docs, tag)
    first = first_rows(classes, class_links(classes, texts))
    copies = rows.groupBy("doc_id", "tag").agg(F.count("*").alias("copies"))
    same = copies["doc_id"].eqNullSafe(first["doc_id"]) & (copies["tag"] == first["tag"])
    names = [unused(docs, name) for name in ("own_id", "own_tag", "own_copies")]
    stay = checkpointed(copies.join(first, same, "left_semi").toDF(*names))
    few = stay.limit(MOST_KEPT + 1).count() <= MOST_KEPT
    own = unused(docs, "tag")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(names[0])) & (F.col(own) == F.col(names[1]))
    found = docs.withColumn(own, tag).join(F.broadcast(stay) if few else stay, same, "left")
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    alone = found.filter(wordless | (F.col(names[2]) == 1))
    several = found.filter(~wordless & (F.col(names[2]) > 1)).dropDuplicates(names[:2])
    return alone.unionByName(several).select(*(F.col(f"`{c}`") for c in docs.columns))
