"""One registered query for each operator, over its whole tables."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm.conversation_repair import damaged, repair_report
from ledgermill.llm.conversation_trie import prefix_trie, rebuilt, turns_of
from ledgermill.llm.decontamination import leaks
from ledgermill.llm.jobs import read, shared_folder, ship
from ledgermill.llm.language_id import held_out, language_id, learn_dictionaries
from ledgermill.llm.language_model import language_model
from ledgermill.llm.license_scan import license_scan
from ledgermill.llm.minhash import minhash_dedup
from ledgermill.llm.ngram_join import ngram_join
from ledgermill.llm.packing import best_fit_packing
from ledgermill.llm.quality_rules import quality_rules
from ledgermill.llm.substring_dedup import substring_dedup
from ledgermill.llm.token_files import read_token_files, write_token_files
from ledgermill.llm.toxicity import toxicity

FILE_TOKENIZER, FILE_END = "word_bpe_49k.json", 1
PACK_TOKENIZER, PACK_END = "byte_bpe_50k.json", 2


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring_dedup(read(spark, folder, "documents"))


def op2_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash_dedup(read(spark, folder, "documents"))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(read(spark, folder, "documents"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = os.path.join(shared_folder(spark), f"tokens-{uuid.uuid4().hex}")
    write_token_files(read(spark, folder, "documents"), files, public_tokenizers.path(FILE_TOKENIZER), FILE_END)
    return read_token_files(spark, files)


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return best_fit_packing(read(spark, folder, "documents"), public_tokenizers.path(PACK_TOKENIZER), PACK_END)


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(read(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    dictionaries = learn_dictionaries(docs.filter(~held_out()))
    found = language_id(docs, dictionaries)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op10_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model(read(spark, folder, "documents"))


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read(spark, folder, "conversations")
    return repair_report(conversations, damaged(conversations))


def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(*rebuilt(turns_of(read(spark, folder, "conversations"))))


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join(read(spark, folder, "documents"))


def _query(work: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: work(ship(spark), folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _query(f)
    for f in (
        op1_substring_dedup,
        op2_minhash,
        op3_license_scan,
        op4_decontamination,
        op5_token_files,
        op6_packing,
        op7_quality_rules,
        op8_toxicity,
        op9_language_id,
        op10_language_model,
        op11_conversation_repair,
        op12_prefix_trie,
        op13_ngram_join,
    )
}
