"""Token files: every document's ids, bit-packed in blocks that can be read alone.

A block holds whole consecutive documents: about ``BLOCK_IDS`` ids, or one longer document. It is a byte
string of its own:

    magic "LMT1", bits u8, 3 bytes of 0, documents u32, ids u64     little-endian, 20 bytes
    validity of the document ids, one bit each, padded to 8 bytes
    document ids, int64 each
    end of each document among the block's ids, u64 each
    the ids, ``bits`` bits each, lowest first, without gaps

Blocks are rows of a Parquet table that Spark writes and commits: shard (documents in ascending id order
over all shards), block (number in its shard), first_id (ids of the shard before it), n_ids, data. To read
one document, take its row and unpack its bits only (``read_document``).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.jobs import SHARD_BYTES, by_batch, shard_count
from ledgermill.llm.tokens import bits_for, encoder, pack, unpack, vocabulary

BLOCK_IDS = 1 << 16
HEAD_CHARS = 32
HEADER = struct.Struct("<4sB3xIQ")
MAGIC = b"LMT1"


def encode_block(doc_ids: list[int | None], ids: list[np.ndarray], bits: int) -> bytes:
    ends = np.cumsum([len(x) for x in ids], dtype="<u8")
    known = np.packbits([d is not None for d in doc_ids], bitorder="little").tobytes()
    every = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    return b"".join(
        (
            HEADER.pack(MAGIC, bits, len(ids), len(every)),
            known + bytes(-len(known) % 8),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            ends.tobytes(),
            pack(every, bits),
        )
    )


class Block:
    """A view of an encoded block; ids are unpacked when asked for."""

    def __init__(self, data: bytes):
        magic, self.bits, n, self.n_ids = HEADER.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = HEADER.size
        known = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n, bitorder="little")
        at += -(-n // 64) * 8
        numbers = np.frombuffer(data, "<i8", n, at)
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known)]
        self.ends = np.frombuffer(data, "<u8", n, at + 8 * n).astype(np.int64)
        self.starts = np.concatenate([[0], self.ends[:-1]]).astype(np.int64)
        self.packed = memoryview(data)[at + 16 * n :]

    def ids(self) -> np.ndarray:
        return unpack(self.packed, self.bits, self.n_ids)

    def read_document(self, i: int) -> np.ndarray:
        """The ids of document ``i`` of the block, without unpacking the others."""
        return unpack(self.packed, self.bits, int(self.ends[i] - self.starts[i]), int(self.starts[i]))


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, block_ids: int = BLOCK_IDS, shard_bytes: int = SHARD_BYTES
) -> None:
    """Encode (doc_id, text) into ``folder``: ascending doc_id, null ids first.

    Each document ends with ``end_id``; a null text has that id alone. A special token in a text has its own
    id. The rows of one id are in the order of their first ``HEAD_CHARS`` characters, then of a hash, null
    texts first. Rows are range-partitioned in that order, and equal rows by their place in the input, so no
    task gets more than its share, whatever part of all rows has one id or one text. They are sorted by
    Spark and encoded as a stream, so a task holds one block.
    """
    bits = bits_for(max(vocabulary(tokenizer), end_id + 1))
    end = np.array([end_id], np.uint32)
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first_id", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts = encoder(tokenizer).each
        block, written, doc_ids, ids, held, shard = 0, 0, [], [], 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"shard": shard, "block": block, "first_id": written, "n_ids": held, "data": encode_block(doc_ids, ids, bits)}], schema
            )

        for batch in batches:
            doc_ids_in, texts, shards = (batch[c].to_pylist() for c in ("doc_id", "text", "shard"))
            for doc_id, found, shard in zip(doc_ids_in, encode_texts(texts), shards):
                own = np.concatenate([found, end])
                if held and held + len(own) > block_ids:
                    yield row()
                    block, written, doc_ids, ids, held = block + 1, written + held, [], [], 0
                doc_ids.append(doc_id)
                ids.append(own)
                held += len(own)
        if held:
            yield row()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.make_valid_utf8(F.col("text").cast("string")).alias("text"))
    own = own.withColumn("head", F.substring("text", 1, HEAD_CHARS)).withColumn("hash", F.xxhash64("text"))
    dealt = own.withColumn("place", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(shard_count(own, "text", shard_bytes), "doc_id", "head", "hash", "place")
    ordered = dealt.sortWithinPartitions("doc_id", "head", "hash", "text").select("doc_id", "text")
    blocks = ordered.withColumn("shard", F.spark_partition_id()).mapInArrow(
        encode, "shard int, block int, first_id long, n_ids long, data binary"
    )
    blocks.write.option("compression", "zstd").parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    The number of ids in each shard, one row a shard, is all that reaches the driver.
    """
    blocks = spark.read.parquet(folder)
    totals = {r["shard"]: r["n"] for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}
    shards = sorted(totals)
    before = dict(zip(shards, np.concatenate([[0], np.cumsum([totals[s] for s in shards])]).astype(int).tolist()))

    def decode(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc_ids, starts, counts, sums = [], [], [], []
        for shard, first, data in zip(*(batch[c].to_pylist() for c in ("shard", "first_id", "data"))):
            block = Block(data)
            raw = memoryview(block.ids().astype("<u4").tobytes())
            doc_ids += block.doc_ids
            starts += (before[shard] + first + block.starts).tolist()
            counts += (block.ends - block.starts).tolist()
            sums += [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(block.starts.tolist(), block.ends.tolist())]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (doc_ids, starts, counts, sums)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return by_batch(blocks.select("shard", "first_id", "data"), decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
