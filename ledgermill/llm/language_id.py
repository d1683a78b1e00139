"""Language ID by compression: the language whose dictionary compresses a text best.

Each language's dictionary is raw content: passages from hashed places of whole training texts, chosen by hash.
A text is lower-cased, reduced to its letters and compressed in blocks, each alone, so that the dictionary and
not the text's own beginning is what shortens it. The language with the smallest sum wins. The margin to the
runner-up decides the score, and a margin below ``min_margin`` is marked as rejected.
"""

from __future__ import annotations

from functools import cache

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.jobs import by_batch, remainder

DICTIONARY_BYTES, PASSAGE_CHARS = 64 << 10, 128
"""Bytes of one dictionary, and characters that one row gives to it: so a dictionary is made of 512 rows or a few more."""

SPARE = 2
"""So many times the rows needed are expected to be chosen, as some have few letters; a sample is at most twice that."""

TRAINED_BYTES = 32 << 20
"""Bound of all dictionaries together, which every task gets."""

BLOCK, MIN_MARGIN = 2_000, 0.01
LEVEL, MIN_MATCH = 6, 3
"""Matches of three bytes: syllables tell languages apart, and the level's own least length is longer."""

NO_LETTERS = regex.compile(r"\P{L}+")


def letters(text: str | None) -> str:
    """The text in lower case, everything that is no letter (Unicode categories L) a single space."""
    return NO_LETTERS.sub(" ", (text or "").lower()).strip()


def learn_dictionaries(docs: DataFrame, chars: int = PASSAGE_CHARS, size: int = DICTIONARY_BYTES) -> dict[str, bytes]:
    """A dictionary for each ``lang``, the most frequent first: the same ones in every run.

    A row is chosen if a hash of its id and text is under a threshold that follows from the number of different
    rows of its language, so all are as likely and none is held against another. It gives ``chars`` characters from a place that
    another hash names, anywhere in its text. Passages of equal hash (repeated rows) count once. Of the passages,
    at most ``2 * SPARE`` times what the dictionaries hold are read to the driver, those of least hash; with more
    languages than ``TRAINED_BYTES`` has room for, each dictionary is smaller. Rows without language, id or text
    teach nothing.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.length("text") > 0))
    number = F.xxhash64("doc_id", "text")
    found = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct(number).alias("different")).collect()
    if not found:
        return {}
    counts = {r["lang"]: r["n"] for r in found}
    size = max(256, min(size, TRAINED_BYTES // len(counts)))
    rows = SPARE * max(1, size // chars)
    wanted = [F.when(F.col("lang") == r["lang"], F.lit(min(1.0, rows / r["different"]))) for r in found]
    share = F.pmod(number, F.lit(1 << 40)) / F.lit(float(1 << 40))
    place = F.pmod(F.xxhash64("text", "doc_id"), F.greatest(F.length("text") - chars, F.lit(0)) + 1) + 1
    passage = F.substring("text", place.cast("int"), F.lit(chars))
    chosen = known.filter(share < F.coalesce(*wanted)).select("lang", number.alias("number"), passage.alias("passage")).distinct()
    parts: dict[str, list[bytes]] = {}
    for r in chosen.orderBy("number", "lang", "passage").limit(2 * rows * len(counts)).collect():
        parts.setdefault(r["lang"], []).append(letters(r["passage"]).encode())
    order = sorted(parts, key=lambda lang: (-counts[lang], lang))
    return {lang: b" ".join(parts[lang])[:size] for lang in order if any(parts[lang])}


@cache
def compressors(dictionaries: tuple[tuple[str, bytes], ...]) -> list[zstandard.ZstdCompressor]:
    params = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, min_match=MIN_MATCH, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    out = []
    for _, content in dictionaries:
        data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(compression_params=params)
        out.append(zstandard.ZstdCompressor(dict_data=data, compression_params=params))
    return out


def sizes(text: str, dictionaries: tuple[tuple[str, bytes], ...]) -> list[int]:
    raw = text.encode("utf-8", "replace")
    blocks = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
    return [sum(len(c.compress(b)) for b in blocks) for c in compressors(dictionaries)]


def language_id(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """doc_id, lang_pred, score, rejected of every row of ``docs`` (doc_id, text).

    ``score`` is m / (m + min_margin) of the margin m, the part by which the best size is under the second.
    Defined cases: a text that is null or has no letter is ``und`` with score 0, and so are all texts if
    nothing was learned; a tie goes to the language learned first and is rejected; with one language
    learned, the score is 1. Repeated rows give repeated results; extra columns are ignored.
    """
    learned = tuple(dictionaries.items())

    def classify(text: str | None) -> tuple[str, float, bool]:
        own = letters(text)
        if not own or not learned:
            return "und", 0.0, True
        found = sizes(own, learned)
        best = min(range(len(found)), key=found.__getitem__)
        rest = [s for i, s in enumerate(found) if i != best]
        margin = 1.0 if not rest else (min(rest) - found[best]) / max(1, min(rest))
        return learned[best][0], 1.0 if not rest else margin / (margin + min_margin), margin < min_margin

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(zip(*map(classify, batch["text"].to_pylist()))) or [[]] * 3
        kinds = (pa.string(), pa.float64(), pa.bool_())
        columns = [batch["doc_id"], *map(pa.array, found, kinds)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "rejected"])

    # bytes that are no valid UTF-8 become replacement characters, which are no letters
    text = F.when(F.col("text").isNotNull(), F.make_valid_utf8(F.col("text"))).alias("text")
    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), work, "doc_id long, lang_pred string, score double, rejected boolean")


def held_out(column: str = "doc_id"):
    """The fold that no language is learned from."""
    return remainder(column, 5) == 0
