"""Conversation prefix trie by fixed-length block hashing.

A turn is the md5 of its role and text. A conversation is cut into blocks of ``BLOCK`` turns, and a block's digest
covers everything up to its end, so conversations with equal digests share their whole prefix. Conversations are
grouped by the digests in front of and behind each block first. Where a prefix goes on in one way only, the turns
inside the block have the members of the block. Only where it goes on in several ways are the blocks, each once,
opened, and their turns grouped by digests that end at each of them.

A node is known by its smallest member and its depth; the nodes with one smallest member are a chain, from the
depth where it becomes the smallest to its end. What lies below a node is the rest of its own chain and the whole
of every chain that leaves it further down; each chain adds its sums to the nodes above it by their digests, which
its conversation's own blocks hold. So no trie is walked, level by level or otherwise.

Long conversations are cut into segments of ``SEGMENT`` turns; only the digest in front of each segment depends on
the ones before, and it is made from one digest for each of those. Texts never leave the task that reads them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.jobs import checkpointed
from ledgermill.llm.sequences import batched, numbered, records, shuffle_tasks, streamed
from ledgermill.operators.skew import spread_join

BLOCK = 8
SEGMENT = 4_096
"""Turns of a conversation that one call works on, a multiple of ``BLOCK``."""

DIGEST = 16
IDS_AT_ONCE = 8_192
"""Ids of conversations that end at one node, in one piece of text."""

HEAD = 3
"""Most turns that a rebuilt conversation takes from another."""

WORD = r"[^\x20\x09-\x0D]+"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, index, digest, words of every turn, numbered from 0 in each conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    whole = F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text").cast("binary")
    rows = rows.filter("conv_id is not null").select(
        "conv_id",
        "turn",
        "role",
        F.md5(F.col("text").cast("binary")).alias("mark"),
        F.unhex(F.md5(whole)).alias("digest"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]
    return numbered(rows, "conv_id", order).select("conv_id", "index", "digest", "words")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, index, digest, words) and all conversations (conv_id), of ``turns_of`` a table.

    The first crc32(conv_id) % 4 turns come from conversation conv_id - conv_id % 20, as many as it has.
    """
    taken = F.crc32(F.col("conv_id").cast("string")) % (HEAD + 1)
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = convs.select("conv_id", "n", taken.cast("int").alias("taken"), (F.col("conv_id") - F.col("conv_id") % 20).alias("donor"))
    heads = turns.filter((F.col("index") < HEAD) & (F.col("conv_id") % 20 == 0)).groupBy(F.col("conv_id").alias("donor"))
    heads = heads.agg(F.array_sort(F.collect_list(F.struct("index", "digest", "words"))).alias("head"))
    convs = convs.join(heads, "donor", "left").withColumn("head", F.slice("head", F.lit(1), F.col("taken")))
    missing = F.col("taken") - F.when(F.col("head").isNull(), 0).otherwise(F.size("head"))
    reached = F.sequence(F.lit(0), F.floor((F.col("n") - 1) / SEGMENT))
    spans = convs.filter("n > taken").select("conv_id", "taken", missing.alias("missing"), F.explode(reached).alias("segment"))
    own = turns.withColumn("segment", F.floor(F.col("index") / SEGMENT)).join(spans, ["conv_id", "segment"]).filter("index >= taken")
    own = own.select("conv_id", (F.col("index") - F.col("missing")).alias("index"), "digest", "words")
    lent = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.index", "t.digest", "t.words")
    return lent.unionByName(own), convs.select("conv_id")


def content(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, segment, digest of all turns of a segment."""
    rows = ((c, s, hashlib.md5(b"".join(d)).digest()) for c, s, d in records(batches, "conv_id", "segment", "digests"))
    return batched(rows, pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("digest", pa.binary())]))


def in_front(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, segment, before: the digest of everything in front of each segment but the first."""

    def rows() -> Iterator[tuple]:
        last, before = None, b""
        for conv, segment, digest in records(batches, "conv_id", "segment", "digest"):
            before = hashlib.md5((before if conv == last else b"") + digest).digest()
            last = conv
            yield conv, segment + 1, before

    return batched(rows(), pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("before", pa.binary())]))


def cut(full: int, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, segment, before, after, depth (in front of it), marks, words of every block.

    The digest behind a full segment is the one that ``in_front`` gives the next segment.
    """

    def rows() -> Iterator[tuple]:
        for conv, segment, digests, words, start in records(batches, "conv_id", "segment", "digests", "words", "before"):
            before = start = start or b""
            for at in range(0, len(digests), block):
                marks = b"".join(digests[at : at + block])
                after = hashlib.md5(before + marks).digest()
                if at + block == full == len(digests):
                    after = hashlib.md5(start + hashlib.md5(b"".join(digests)).digest()).digest()
                yield conv, segment, before, after, segment * full + at, marks, words[at : at + block]
                before = after

    fields = [("conv_id", pa.int64()), ("segment", pa.int64()), ("before", pa.binary()), ("after", pa.binary())]
    fields += [("depth", pa.int64()), ("marks", pa.binary()), ("words", pa.list_(pa.int64()))]
    return batched(rows(), pa.schema(fields), 512)


def opened(blocks: DataFrame, up_to, *columns: str) -> DataFrame:
    """``columns``, with key, parent, depth and words of the first ``up_to`` turns of each block as nodes."""
    key = lambda t: F.unhex(F.md5(F.concat("before", F.substring("marks", 1, DIGEST * t))))
    rows = blocks.withColumn("t", F.explode(F.sequence(F.lit(1), up_to.cast("int"))))
    t = F.col("t")
    return rows.select(
        *columns,
        F.when(DIGEST * t == F.octet_length("marks"), F.col("after")).otherwise(key(t)).alias("key"),
        F.when(t == 1, F.col("before")).otherwise(key(t - 1)).alias("parent"),
        (F.col("depth") + t).alias("depth"),
        F.element_at("words", t).alias("words"),
    )


def id_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, first, ids: runs of sorted ids of one key, as text."""

    def rows() -> Iterator[tuple]:
        last, held = None, []
        for key, conv in records(batches, "key", "conv_id"):
            if held and (key != last or len(held) == IDS_AT_ONCE):
                yield last, held[0], ",".join(map(str, held))
                held = []
            last = key
            held.append(conv)
        if held:
            yield last, held[0], ",".join(map(str, held))

    return batched(rows(), pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())]))


def hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, ends_sha256 of the pieces of each key, hashed as they pass."""

    def rows() -> Iterator[tuple]:
        last, found = None, hashlib.sha256()
        for key, ids in records(batches, "key", "ids"):
            if last is not None and key != last:
                yield last, found.hexdigest()
                found = hashlib.sha256()
            elif last is not None:
                found.update(b",")
            last = key
            found.update(ids.encode())
        if last is not None:
            yield last, found.hexdigest()

    return batched(rows(), pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())]))


def ends_of(ends: DataFrame) -> DataFrame:
    """key, ends_sha256: the ids of each key in rising order, joined by commas, hashed.

    Ids are dealt by ranges of (key, id) and joined to pieces; the hash of a key runs over its pieces.
    """
    order = [F.col("key"), F.col("conv_id")]
    pieces = ends.repartitionByRange(shuffle_tasks(ends), *order).sortWithinPartitions(*order)
    pieces = pieces.mapInArrow(id_pieces, "key binary, first long, ids string")
    return streamed(pieces, "key", [F.col("first")]).mapInArrow(hashed_ids, "key binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct prefix of the conversations ``convs`` (conv_id) with ``turns`` (conv_id, index, digest, words).

    Indexes run from 0 without gaps. Returns conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256. Defined cases: a conversation without turns is a member of
    the root alone and ends there; without conversations there is no root. ``turns_of`` leaves out rows without a
    conv_id, which belong to no conversation, takes a null role or text as empty, and orders rows of one turn by
    role and the md5 of their text. Extra columns are ignored.
    """
    root = F.lit(b"")
    segments = turns.groupBy("conv_id", F.floor(F.col("index") / SEGMENT).alias("segment"))
    segments = segments.agg(F.array_sort(F.collect_list(F.struct("index", "digest", "words"))).alias("t"))
    segments = segments.select("conv_id", "segment", F.col("t.digest").alias("digests"), F.col("t.words").alias("words"))
    full = segments.filter(F.size("digests") == SEGMENT).select("conv_id", "segment", "digests")
    full = full.mapInArrow(content, "conv_id long, segment long, digest binary")
    starts = streamed(full, "conv_id", [F.col("segment")]).mapInArrow(in_front, "conv_id long, segment long, before binary")
    schema = "conv_id long, segment long, before binary, after binary, depth long, marks binary, words array<long>"
    blocks = checkpointed(segments.join(starts, ["conv_id", "segment"], "left").mapInArrow(partial(cut, SEGMENT, BLOCK), schema))

    size = (F.octet_length("marks") / DIGEST).cast("int")
    columns = [F.first(c).alias(c) for c in ("depth", "marks", "words")]
    distinct = blocks.groupBy("before", "after").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *columns)
    distinct = checkpointed(distinct)
    ways = distinct.groupBy("before").agg(F.count("*").alias("ways"), F.first("after").alias("after"))
    alone = ways.filter("ways = 1").select("after", F.lit(True).alias("alone"))
    distinct = distinct.join(alone, "after", "left")
    node = ("key", "parent", "depth", "conv_id", "n_convs", "words")
    calm = opened(distinct.filter("alone"), size, "conv_id", "n_convs").select(*node)
    torn = opened(distinct.filter("alone is null"), size, "conv_id", "n_convs").groupBy("key").agg(
        *(F.first(c).alias(c) for c in ("parent", "depth")),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.first("words").alias("words"),
    )
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(
        root.alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).cast("long").alias("words")
    )
    nodes = calm.unionByName(torn.select(*node)).unionByName(top)
    nodes = checkpointed(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("words")).withColumn("segment", F.floor(F.col("depth") / SEGMENT)))

    chains = nodes.groupBy("conv_id").agg(
        F.min("depth").alias("top"),
        F.max_by("key", "depth").alias("last"),
        F.min_by("parent", "depth").alias("parent"),
        F.sum("own").alias("saved"),
    )
    attached = chains.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("attached"))
    leaf = F.when(F.col("attached").isNull(), 1).otherwise(0).cast("long")
    chains = chains.join(attached.withColumnRenamed("key", "last"), "last", "left").withColumn("leaf", leaf).drop("attached")
    chains = checkpointed(chains)

    sums = [F.sum(c).alias(c) for c in ("saved", "leaf")]
    spans = chains.filter("top > 1 and (saved > 0 or leaf > 0)")
    spans = spans.select("conv_id", "top", "saved", "leaf", F.explode(F.sequence(F.lit(0), F.floor((F.col("top") - 2) / SEGMENT))).alias("segment"))
    above = blocks.select("conv_id", "segment", "before", "after", "depth", "marks", "words").join(spans, ["conv_id", "segment"])
    above = above.withColumn("take", F.least(size.cast("long"), F.col("top") - 1 - F.col("depth"))).filter("take > 0")
    above = above.groupBy("before", "after", "take").agg(*columns, *sums)
    received = opened(above, F.col("take"), "saved", "leaf").groupBy("key").agg(*sums)
    received = received.unionByName(chains.filter("top > 0").agg(*sums).select(root.alias("key"), "saved", "leaf"))

    facts = ("attached", "saved", "leaf", "goes_on", "ends_sha256")
    kinds = {c: "long" for c in facts} | {"ends_sha256": "string"}
    last_blocks = blocks.groupBy("conv_id").agg(F.max_by("after", "depth").alias("key"))
    ends = convs.join(last_blocks, "conv_id", "left").select("conv_id", F.coalesce("key", root).alias("key"))
    every = None
    for found in (attached, received, chains.select(F.col("last").alias("key"), F.lit(0).cast("long").alias("goes_on")), ends_of(ends)):
        found = found.select("key", *(F.col(c) if c in found.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()))
        every = found if every is None else every.unionByName(found)
    facts_of = every.groupBy("key").agg(*(F.max(c).alias(c) for c in facts))

    parts = nodes.groupBy("conv_id", "segment").agg(F.sum("own").alias("own"))
    later = Window.partitionBy("conv_id").orderBy(F.col("segment").desc()).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.join(chains.select("conv_id", F.col("leaf").alias("chain_leaf")), "conv_id")
    parts = parts.select("conv_id", "segment", "chain_leaf", F.coalesce(F.sum("own").over(later), F.lit(0)).alias("later"))
    below = Window.partitionBy("conv_id", "segment").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    owners = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    tops = spread_join(chains.filter("parent is not null").select("conv_id", F.col("top").alias("depth"), "parent"), owners, "parent", ["conv_id"])
    known = nodes.withColumn("rest", F.sum("own").over(below)).join(parts, ["conv_id", "segment"])
    known = known.join(facts_of, "key", "left").join(tops.select("conv_id", "depth", "parent_conv_id"), ["conv_id", "depth"], "left")
    zero = F.lit(0).cast("long")
    return known.select(
        "conv_id",
        "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"),
        "n_convs",
        (F.coalesce("attached", zero) + F.coalesce("goes_on", F.lit(1).cast("long"))).alias("n_children"),
        (F.col("chain_leaf") + F.coalesce("leaf", zero)).alias("n_leaves"),
        (F.col("rest") + F.col("later") + F.coalesce("saved", zero)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
