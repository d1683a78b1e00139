"""A training corpus from ``documents`` in stages; each stage reads what the one before it wrote."""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm.decontamination import without_leaks
from ledgermill.llm.jobs import read, shared_folder, ship, unused
from ledgermill.llm.minhash import first_copies
from ledgermill.llm.packing import best_fit_packing
from ledgermill.llm.queries import PACK_END, PACK_TOKENIZER
from ledgermill.llm.substring_dedup import substring_dedup
from ledgermill.llm.toxicity import toxicity


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs``, written with a unique number for each row, and that column's name: an id may stand in many rows."""
    key = unused(docs, "_row")
    path = os.path.join(shared_folder(docs.sparkSession), f"rows-{uuid.uuid4().hex}")
    docs.withColumn(key, F.monotonically_increasing_id()).write.parquet(path)
    return docs.sparkSession.read.parquet(path), key


def only(docs: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows of ``docs`` whose number is in ``found``, without it."""
    return docs.join(found.select(key), key, "left_semi").drop(key)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected rows go; the model learns from the labels of the documents given.

    Rows are decided on one by one, also those of one id or none; a row without text is judged as an empty one.
    """
    rows, key = keyed(docs)
    return only(rows, toxicity(rows, read(spark, sf_dir, "labels"), key).filter("predicted = 0"), key)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row of smallest id stays, a null id being the smallest; of equal rows, one."""
    return first_copies(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in a row of smaller id, or earlier in the row, go from the text; ``n_chars`` follows.

    Every row stays and a null text is null. A null id is the smallest; rows of one id follow each other by a hash
    of all their columns, and equal rows cut nothing from each other.
    """
    tie = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    found = substring_dedup(docs, carry=[c for c in docs.columns if c not in ("doc_id", "text")], tie=tie)
    text = F.col("kept_text").cast("string")
    changed = {
        "doc_id": F.col("doc_id"),
        "text": text,
        "n_chars": F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("carried.n_chars")),
    }
    return found.select(
        *(changed.get(f.name, F.col(f"carried.`{f.name}`")).cast(f.dataType).alias(f.name) for f in docs.schema)
    )


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go; a row without text holds none."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every row and their places; a null text is its end id alone."""
    return best_fit_packing(docs, public_tokenizers.path(PACK_TOKENIZER), PACK_END)


def _stage(work):
    return lambda spark, docs, sf_dir: work(ship(spark), docs, sf_dir)


STAGES = [
    ("toxicity", _stage(drop_toxic)),
    ("near_duplicates", _stage(drop_near_duplicates)),
    ("substring_dedup", _stage(cut_repeats)),
    ("decontamination", _stage(drop_leaks)),
    ("packing", _stage(pack)),
]

#: The learned scores, similarity joins and token ids have no form in SQL; the tests hold each stage against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    folder = os.path.join(shared_folder(spark), f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
