import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgermill.llm.jobs import releasing
from ledgermill.llm.packing import best_fit_packing, plan
from ledgermill.llm.text import CHUNK_BYTES, POWERS
from ledgermill.llm.token_files import Block, encode_block, read_token_files, write_token_files
from ledgermill.llm.tokens import ENCODERS, PIECE, UNSAFE, Encoder, bits_for, encoder, is_unsafe, pack, pieces_of, unpack

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
WHOLE = {}


def whole(name, text):
    if name not in WHOLE:
        WHOLE[name] = Tokenizer.from_file(public_tokenizers.path(name))
    return WHOLE[name].encode(text or "", add_special_tokens=False).ids


TEXTS = ["", " ", "a", "It's  we'll\n\n x", "ÀÉ ñ́ é ́x", "a   b　", "1234 56,7 \t\t", "don't'", "<|endoftext|> x", "  \n lead", "trail \n "]


@pytest.mark.parametrize("name", FILES)
def test_pieces_equal_one_call_over_the_text(name):
    encode = encoder(public_tokenizers.path(name))

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from([*TEXTS, "<|endoftext|>", "<|startoftext|>", "<|", "|>", "\x1c", "\x85", "​", "'s", "'", "ab", "Ab,", "...", "中文", "🙂", "ͅ", "İ"])).map("".join) | st.text())
    def check(text):
        assert encode(text).tolist() == whole(name, text)

    check()
    for text in TEXTS:
        assert encode(text).tolist() == whole(name, text)
    words = st.text(st.sampled_from("abEZßÀÖØöøÿéç×÷ĲŒİ.,;:!?*$%&#|'-"), min_size=1, max_size=8)

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(words, max_size=6), st.sampled_from([" ", "\n", "  ", " \n", "\t"]))
    def check_words(parts, white):
        text = white.join(parts)
        assert encode(text).tolist() == whole(name, text)

    check_words()
    assert encode.pieces.encode == encode.piece


SIGNS = st.text(st.sampled_from("'''''stremvldSTREVMLxÀÖ×÷ßÿªµº²¼½¹57 \n\t\0\x1b\x7f\x80\x9f\x85\xa0–’“…€™<|!?.,"), max_size=30)


@pytest.mark.parametrize("size", [1, 20, 1 << 20])
@pytest.mark.parametrize("name", FILES)
def test_texts_encoded_together_equal_one_call_each(name, size, monkeypatch):
    monkeypatch.setattr("ledgermill.llm.tokens.CHUNK_CHARS", size)
    encode = encoder(public_tokenizers.path(name))
    assert encode.joins and encode.folding == (name == FILES[0])

    @settings(max_examples=300, deadline=None)
    @given(st.lists(SIGNS | st.sampled_from([None, *TEXTS]) | st.text(max_size=5), max_size=8))
    def check(texts):
        assert [x.tolist() for x in encode.each(texts)] == [whole(name, t) for t in texts]

    check()


def test_a_worker_forgets_encoders_and_long_tables():
    encode = encoder(public_tokenizers.path(FILES[1]))
    list(encode.each(["a few words", "İ"]))
    assert encode.joint and ENCODERS
    assert len(list(releasing(iter)([1, 2]))) == 2
    assert not encode.joint and not encode.pieces and not ENCODERS
    assert list(encode.each(["a"]))[0].tolist() == whole(FILES[1], "a")
    up, down = POWERS.of(10 * CHUNK_BYTES)
    assert (up * down == 1).all() and len(POWERS.up) <= 2 * CHUNK_BYTES


def test_the_model_is_asked_once_for_each_word_of_plain_texts():
    encode, asked = Encoder(public_tokenizers.path(FILES[0])), []
    encode.joint.clear()
    tokenize, encode.tokenize = encode.tokenize, lambda word: asked.append(word) or tokenize(word)
    texts = ["The the, THE\nthe! It's", " thE;  the..."]
    assert [x.tolist() for x in encode.each(texts)] == [whole(FILES[0], t) for t in texts]
    assert sorted(asked) == sorted(["the", ",", "!", "it", "'s", ";", "..."])


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 32), st.data())
def test_packing_of_bits_round_trips(bits, data):
    ids = np.array(data.draw(st.lists(st.integers(0, (1 << bits) - 1), max_size=60)), np.uint32)
    raw = pack(ids, bits)
    assert len(raw) == -(-len(ids) * bits // 8)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert unpack(raw, bits, b - a, a).tolist() == ids[a:b].tolist()


def test_bits_and_blocks():
    assert [bits_for(n) for n in (1, 2, 3, 49408, 50257, 65536, 65537)] == [1, 1, 2, 16, 16, 16, 17]
    docs = [np.arange(5, dtype=np.uint32), np.zeros(0, np.uint32), np.array([70000], np.uint32)]
    block = Block(encode_block([3, None, -1], docs, 17))
    assert block.doc_ids == [3, None, -1] and block.ids().tolist() == [0, 1, 2, 3, 4, 70000]
    assert [block.read_document(i).tolist() for i in range(3)] == [d.tolist() for d in docs]


def corpus():
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["Word", "é", "x,", "yz", "\n"]) for _ in range(rng.randrange(400)))) for i in range(80)]
    rng.shuffle(rows)
    return rows + [(7, "a <|endoftext|> b"), (8, "<|startoftext|>x\n<|endoftext|>"), (None, "null id"), (100, None), (101, ""), (102, "long text " * 30000), (5, "again"), (5, "again")]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("block_ids,shard_bytes", [(1 << 16, 1 << 20), (300, 5000)])
def test_files_hold_every_document_in_order(spark, tmp_path, block_ids, shard_bytes):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, shard int")
    write_token_files(docs, str(tmp_path / "t"), public_tokenizers.path(FILES[0]), 1, block_ids, shard_bytes)
    got = sorted(map(tuple, read_token_files(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    expected, start = [], 0
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*whole(FILES[0], t), 1]
        expected.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == expected


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("ab,é \n\t\x0b\r\0\x1c\x1f\x85\u3000<|"), max_size=12) | st.lists(st.sampled_from(["a", "é,", "b\n", " "]), max_size=9).map(" ".join))
def test_splitting_equals_the_expressions(text):
    assert [p for p in pieces_of(text) if p] == PIECE.findall(text)
    assert is_unsafe(text) == bool(UNSAFE.search(text))


def test_plain_texts_are_split_without_the_expression(monkeypatch):
    monkeypatch.setattr("ledgermill.llm.tokens.PIECE", None)
    assert pieces_of("A few words,\nof two lines ") == ["A", " few", " words,", "\nof", " two", " lines", " "]


def test_special_tokens_have_their_ids():
    assert encoder(public_tokenizers.path(FILES[0]))("a <|endoftext|> b").tolist() == [320, 49407, 321]
    assert encoder(public_tokenizers.path(FILES[1]))("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def test_a_hot_id_is_dealt_over_the_shards(spark, tmp_path):
    """A third of the ids is null and a third of the rows equal: no shard holds much more than its share."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} " * 20 if i % 3 != 1 else "same " * 30) for i in range(3_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    write_token_files(docs, str(tmp_path / "t"), public_tokenizers.path(FILES[0]), 1, 300, 30_000)
    shards = {r["shard"]: r["n"] for r in spark.read.parquet(str(tmp_path / "t")).groupBy("shard").agg({"n_ids": "sum"}).toDF("shard", "n").collect()}
    assert len(shards) > 10 and max(shards.values()) < 3 * sum(shards.values()) / len(shards)
    got = sorted(map(tuple, read_token_files(spark, str(tmp_path / "t")).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    ends = [r[1] + r[2] for r in got]
    assert [0, *ends[:-1]] == [r[1] for r in got]


def test_no_documents(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    write_token_files(docs, str(tmp_path / "t"), public_tokenizers.path(FILES[0]), 1)
    assert read_token_files(spark, str(tmp_path / "t")).collect() == []
    assert best_fit_packing(docs, public_tokenizers.path(FILES[1]), 2).collect() == []


def best_fit(lengths, cap):
    """Sequences of best-fit decreasing, one piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(cap - n)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=120))
def test_plan_equals_best_fit_on_pieces(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    runs, sequences = plan(counts, 30)
    assert sequences == best_fit(lengths, 30)
    for n, own in runs.items():
        assert [r.rank for r in own] == np.cumsum([0] + [r.n for r in own])[:-1].tolist() and sum(r.n for r in own) == counts[n]


@pytest.mark.parametrize("cap", [1024, 16])
def test_every_piece_has_a_place_of_its_own(spark, cap):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rank int").repartition(5)
    got = best_fit_packing(docs, public_tokenizers.path(FILES[1]), 2, cap).collect()
    expected = []
    for d, t in rows:
        ids = [*whole(FILES[1], t), 2]
        stops = list(range(len(ids) % cap or cap, len(ids) + 1, cap))
        for k, (a, b) in enumerate(zip([0, *stops], stops)):
            expected.append((d, k, a, b - a, crc(ids[a:b])))
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(expected, key=str)
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= cap
    assert len(by_sequence) == best_fit([e[3] for e in expected], cap)
