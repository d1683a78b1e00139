"""What joins of similar shingle sets share: sets, classes of equal sets, cells and places, and links as rows' components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.components import components
from ledgermill.llm.jobs import by_batch, checkpointed, releasing, utf8
from ledgermill.llm.sequences import shuffle_tasks
from ledgermill.llm.text import U64, chunks, mix, span_hashes
from ledgermill.operators.filters import by_filter, key_filter
from ledgermill.operators.skew import spread_join

SHINGLE = 5

COLUMNS = 4_096
"""Shingles of a place that are counted at once."""

BROADCAST_PLACES = 500_000
"""Up to so many rows of places (64 bytes each) are broadcast to the texts; beyond, they are joined by a shuffle."""

SAME = ("n_shingles", "left", "right")


# -- sets --------------------------------------------------------------------------------------


def shingles(column: pa.ChunkedArray | pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The distinct shingle hashes of each text, sorted. A text of fewer words is one shingle; of none, none."""
    for texts in chunks(column):
        words = texts.words(fold=True)
        hashes, first = words.hashes(), words.first
        runs = span_hashes(hashes, size)
        for i in range(len(texts)):
            a, b = first[i], first[i + 1]
            if b - a >= size:
                yield np.unique(runs[a : b - size + 1])
            elif b > a:
                yield mix(span_hashes(hashes[a:b], int(b - a)) + U64(b - a))
            else:
                yield np.zeros(0, U64)


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    pair = (mix(s), mix(s ^ U64(0x5851F42D4C957F2D)))
    return tuple(int(h.sum(dtype=U64).view(np.int64)) for h in pair)


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """The size of the intersection of every two sets: products of 0 and 1 over the shingles that two sets have."""
    every = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(every, return_inverse=True, return_counts=True)
    number = np.cumsum(count > 1) - 1
    use = count[column] > 1
    row, column = row[use], number[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - low] = 1
        out += part @ part.T
    return out


def spanning(linked: np.ndarray) -> np.ndarray:
    """For every row of a symmetric matrix of links, the first row that it reaches."""
    reach, label = linked | np.eye(len(linked), dtype=bool), np.arange(len(linked))
    while True:
        least = np.where(reach, label[None, :], len(label)).min(1)
        least = least[least]
        if (least == label).all():
            return label
        label = least


# -- shared keys -------------------------------------------------------------------------------


def sent_on(keys: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    """key, doc_id, shared of a batch's keys. Of a key with several documents in the batch, one row that does not
    know of the others (``shared`` false) goes on for all of them; other batches may have the key too.
    """
    order = np.lexsort((docs, keys))
    keys, docs = keys[order], docs[order]
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    size = np.diff(np.append(np.flatnonzero(new), len(keys)))[np.cumsum(new) - 1]
    several = size > 1
    key = np.concatenate([keys[new], keys[several]]).view(np.int64)
    shared = np.repeat([False, True], [new.sum(), several.sum()])
    columns = [pa.array(key), pa.array(np.concatenate([docs[new], docs[several]])), pa.array(shared)]
    return pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "shared"])


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, doc_id of the keys that several documents have, from rows sorted by key and id.

    Rows that are known to be shared pass. Of the others, those of one key follow each other; only the last
    row is remembered from batch to batch.
    """
    last: tuple[int, int, bool] | None = None  # key, id, whether that row was given out
    for batch in batches:
        known = np.asarray(batch["shared"].to_numpy(zero_copy_only=False), bool)
        keys, docs = (np.asarray(batch[c]) for c in ("key", "doc_id"))
        out = [(keys[known], docs[known])]
        keys, docs = keys[~known], docs[~known]
        if len(keys):
            given = False
            if last and last[0] == keys[0]:
                keys, docs = np.concatenate([[last[0]], keys]), np.concatenate([[last[1]], docs])
                given = last[2]
            same = np.zeros(len(keys) + 1, bool)
            same[1:-1] = keys[1:] == keys[:-1]
            use = same[:-1] | same[1:]
            last = (int(keys[-1]), int(docs[-1]), bool(use[-1]))
            use[0] &= not given
            out.append((keys[use], docs[use]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["key", "doc_id"])


def members_of(classes: DataFrame, keys: Callable[[pa.RecordBatch], pa.RecordBatch]) -> DataFrame:
    """key, doc_id of all keys that several classes have; ``keys`` makes them, through ``sent_on``."""
    made = by_batch(classes, keys, "key long, doc_id long, shared boolean")
    dealt = F.when(F.col("shared"), F.col("doc_id")).otherwise(F.lit(0))
    made = made.repartition(shuffle_tasks(classes), F.col("key"), dealt).sortWithinPartitions("key", "doc_id")
    return checkpointed(made.mapInArrow(releasing(shared_keys), "key long, doc_id long").distinct())


def centers(members: DataFrame) -> DataFrame:
    """center, doc_id: the cells. A key's center is the document whose keys have the most documents."""
    counts = members.groupBy("key").agg(F.count("*").alias("n"))
    weight = members.join(counts, "key").groupBy("doc_id").agg(F.sum("n").alias("weight"))
    best = members.join(weight, "doc_id").groupBy("key").agg(F.max_by("doc_id", F.struct("weight", -F.col("doc_id"))).alias("center"))
    return checkpointed(members.join(best, "key").select("center", "doc_id").distinct())


# -- classes -----------------------------------------------------------------------------------


def tagged(docs: DataFrame, tag=None) -> DataFrame:
    """doc_id, tag, text (bytes): ``tag`` tells the texts of one id apart, by default their hash."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"), *([tag.alias("tag")] if tag is not None else []))
    return texts if tag is not None else texts.withColumn("tag", F.xxhash64("text"))


def classes_of(rows: DataFrame, made: DataFrame, carried: str) -> DataFrame:
    """doc_id (a number for each class of equal sets), n_shingles, left, right, origin (least id, tag), repeated, ``carried``.

    ``made`` has ``carried`` beside what ``rows`` (doc_id, tag, n_shingles, left, right) have; rows of one class
    have equal values of it. They are combined before the shuffle, so the copies of a text cost one row a task.
    ``repeated``: several rows have the id and tag of the origin.
    """
    origin = F.min(F.struct(F.col("doc_id").alias("id"), "tag")).alias("origin")
    classes = made.filter("n_shingles > 0").groupBy(*SAME).agg(origin, F.first(carried).alias(carried))
    classes = checkpointed(classes).withColumn("doc_id", F.monotonically_increasing_id())
    again = rows.groupBy("doc_id", "tag").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag"))
    same = F.col("origin.id").eqNullSafe(F.col("_id")) & (F.col("origin.tag") == F.col("_tag"))
    marks = checkpointed(classes.select("doc_id", "origin").join(again, same).select("doc_id"))
    # distinct, though they are: who does not ask for ``repeated`` is then spared the join, which shuffles ``carried``
    marks = marks.distinct().withColumn("repeated", F.lit(True))
    return classes.join(marks, "doc_id", "left").withColumn("repeated", F.coalesce("repeated", F.lit(False)))


def similar_sizes(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


# -- cells and places --------------------------------------------------------------------------


def mixed_cells(cells: DataFrame, links: DataFrame) -> DataFrame:
    """center, doc_id, component of the cells whose classes lie in several components of ``links``."""
    found = components(links)
    own = cells.join(found, cells["doc_id"] == found["node"], "left")
    own = own.select("center", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = own.groupBy("center").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y")
    return checkpointed(own.join(mixed.select("center"), "center", "left_semi"))


def placed(cells: DataFrame, block: int) -> DataFrame:
    """Rows of cells (center, doc_id, component, ...) with the places they are compared in, sorted by place.

    Classes of a cell's largest component are compared with the others only: each block of theirs meets each
    block of the others once. Blocks of the others meet each other and themselves. ``own`` tells the two sides
    of a place apart and is below 0 where a block meets itself. ``block`` is about how many rows a block has.
    """
    sizes = cells.groupBy("center", "component").agg(F.count("*").alias("n")).groupBy("center").agg(
        F.max(F.struct("n", "component")).alias("most"), F.sum("n").alias("all")
    )
    blocks = lambda n: F.greatest(F.ceil(n / F.lit(block)), F.lit(1)).cast("long")
    sizes = sizes.select(
        "center",
        F.col("most.component").alias("largest"),
        blocks(F.col("most.n")).alias("large_blocks"),
        blocks(F.col("all") - F.col("most.n")).alias("small_blocks"),
    )
    rows = cells.join(sizes, "center").withColumn("large", F.col("component") == F.col("largest"))
    count = F.when(F.col("large"), F.col("large_blocks")).otherwise(F.col("small_blocks"))
    rows = rows.withColumn("own_block", F.pmod(F.xxhash64("doc_id"), count))
    place = lambda value, own: F.struct(value.cast("long").alias("place"), own.cast("int").alias("own"))
    small, own_block = F.col("small_blocks"), F.col("own_block")
    up_to = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    with_large = F.transform(up_to(F.col("large_blocks")), lambda i: place(i * small + own_block, F.lit(1)))
    with_small = F.transform(
        up_to(small),
        lambda i: place(
            (F.col("large_blocks") + F.least(i, own_block)) * small + F.greatest(i, own_block),
            F.when(i == own_block, F.lit(-1)).otherwise(own_block),
        ),
    )
    of_large = F.transform(up_to(small), lambda i: place(own_block * small + i, F.lit(0)))
    every = F.when(F.col("large"), of_large).otherwise(F.concat(with_large, with_small))
    return rows.withColumn("at", F.explode(every)).select(*cells.columns, "at.place", "at.own")


def star_places(stars: DataFrame, block: int) -> DataFrame:
    """Places in which each center meets the others of its pairs (a: center, b), ``block`` of them or so in one."""
    counts = stars.groupBy("a").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("blocks"))
    others = spread_join(stars, counts, "a", ["b"])
    row = lambda doc, place, own: (F.col("a").alias("center"), doc.alias("doc_id"), doc.alias("component"), place.alias("place"), F.lit(own).alias("own"))
    others = others.select(*row(F.col("b"), F.pmod(F.xxhash64("b"), F.col("blocks")), 1))
    each = counts.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return others.unionByName(each.select(*row(F.col("a"), F.col("at"), 0)))


def by_place(rows: DataFrame) -> DataFrame:
    return rows.repartition(shuffle_tasks(rows), "center", "place").sortWithinPartitions("center", "place", "doc_id")


def of_keys(rows: DataFrame, columns: list[str], keys: DataFrame) -> DataFrame:
    """Those of ``rows`` whose ``columns`` are a row of ``keys``, and a few others; no row is shuffled."""
    words, n = key_filter(keys, keys.count())
    return by_filter(rows, columns, checkpointed(words), n)


def with_texts(rows: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows of places with the texts of their classes, by place: the one shuffle of these texts.

    A class is found by the id and tag of one of its texts. Up to ``BROADCAST_PLACES`` rows are broadcast to the
    texts; beyond, both are shuffled once more, of the texts only those that a filter of the classes lets pass.
    Of a text that stands in several equal rows, one comes.
    """
    rows = checkpointed(rows.join(classes.select("doc_id", "origin.id", F.col("origin.tag").alias("own_tag"), "repeated"), "doc_id"))
    texts = texts.select(F.col("doc_id").alias("text_id"), "tag", "text")
    if rows.limit(BROADCAST_PLACES + 1).count() <= BROADCAST_PLACES:
        wanted = F.broadcast(rows)
    else:
        wanted, texts = rows, of_keys(texts, ["text_id", "tag"], rows.select("id", "own_tag").distinct())
    found = texts.join(wanted, F.col("text_id").eqNullSafe(F.col("id")) & (F.col("tag") == F.col("own_tag")))
    found = found.select("center", "place", "doc_id", "component", "own", "repeated", "text")
    once = found.filter("repeated").dropDuplicates(["center", "place", "doc_id"])
    return by_place(found.filter("NOT repeated").unionByName(once).drop("repeated"))


def places(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """The rows of each place (center, place) in turn, from rows sorted by it; a place holds two blocks at most."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch]).select(["center", "place", *columns])
        rows = rows if rest is None else pa.concat_tables([rest, rows])
        center, place = (rows[c].to_numpy() for c in ("center", "place"))
        cuts = [0, *(np.flatnonzero((center[1:] != center[:-1]) | (place[1:] != place[:-1])) + 1)]
        for a, b in zip(cuts, cuts[1:]):
            yield rows.slice(a, b - a)
        rest = rows.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def across(label: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which pairs of a place to compare: of different components and, where two blocks meet, of different blocks."""
    pairs = label[:, None] != label[None, :]
    return pairs & (own[:, None] != own[None, :]) if own[0] >= 0 else pairs


def linked_across(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """a, b: links that connect what the full sets of a place's classes show to be connected."""
    for rows in places(batches, ["doc_id", "component", "own", "text"]):
        doc, label, own = (rows[c].to_numpy() for c in ("doc_id", "component", "own"))
        use = across(label, own)
        if not use.any():
            continue
        sets = list(shingles(rows["text"]))
        size, both = np.array([len(s) for s in sets]), intersections(sets)
        root = spanning(use & (both > 0) & (100 * both >= percent * (size[:, None] + size[None, :] - both)))
        moved = root != np.arange(len(doc))
        yield pa.RecordBatch.from_arrays([pa.array(doc[root[moved]]), pa.array(doc[moved])], ["a", "b"])


def links_at(rows: DataFrame, classes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """a, b: links that connect what is connected by whole sets in the places of ``rows``."""
    found = with_texts(rows, classes, texts).mapInArrow(releasing(partial(linked_across, percent=percent)), "a long, b long")
    return checkpointed(found)


# -- rows --------------------------------------------------------------------------------------


def row_components(rows: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest id that links between classes reach.

    Rows of one id are one document: their classes are linked too. A row without an id has no component.
    A class, or an id, may have a large part of all rows.
    """
    rows = rows.withColumn("row", F.monotonically_increasing_id()).withColumn("code", F.xxhash64(*SAME))
    known = rows.filter("doc_id is not null and n_shingles > 0").select("row", "doc_id", "code", *SAME)
    of_class = classes.select(F.col("doc_id").alias("class"), F.xxhash64(*SAME).alias("code"), *(F.col(c).alias(f"class_{c}") for c in SAME))
    held = spread_join(known, of_class, "code", ["row"]).filter(" and ".join(f"{c} = class_{c}" for c in SAME))
    held = checkpointed(held.select("doc_id", "class").distinct())
    several = held.groupBy("doc_id").agg(F.min("class").alias("a"), F.count("*").alias("n")).filter("n > 1").select("doc_id", "a")
    joined = spread_join(held, several, "doc_id", ["class"]).filter("a <> class").select("a", F.col("class").alias("b"))
    found = components(links.union(joined))
    label = F.coalesce("component", "doc_id").alias("label")
    labels = classes.join(found, F.col("doc_id") == F.col("node"), "left").select(F.col("doc_id").alias("class"), "origin.id", label)
    labels = checkpointed(labels)
    least = labels.groupBy("label").agg(F.min("id").alias("component_id"))
    labels = checkpointed(spread_join(labels, least, "label", ["class"]).select("class", "component_id"))
    of_doc = checkpointed(spread_join(held, labels, "class", ["doc_id"]).groupBy("doc_id").agg(F.min("component_id").alias("component_id")))
    result = spread_join(rows.select("row", "doc_id", "n_shingles"), of_doc, "doc_id", ["row"], "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def first_rows(classes: DataFrame, links: DataFrame) -> DataFrame:
    """doc_id, tag of the first row of each component of classes, by id (null first) and tag; here ids join nothing."""
    found = components(links)
    label = F.coalesce("component", "doc_id").alias("label")
    labels = classes.join(found, F.col("doc_id") == F.col("node"), "left").select("origin", label)
    return labels.groupBy("label").agg(F.min("origin").alias("first")).select(F.col("first.id").alias("doc_id"), F.col("first.tag").alias("tag"))
