import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgermill.llm.language_model import CLASSES, ROWS, START, Stream, Trainer, language_model, log_softmax
from ledgermill.llm.text import chunks


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")), None]


def fold(doc_id):
    return zlib.crc32(("null" if doc_id is None else str(doc_id)).encode()) % 7


def brute(rows):
    counts = Counter(t for d, text in rows if fold(d) != 2 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for d, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (n + 1 * (v + 1))) for t in own)
        out.append((d, fold(d) == 2, len(own), sum(counts[t] > 0 for t in own), n, base))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(12)
    kinds = [["kalo", "mi", "Tun", "lor,"], ["schr", "engö", "ung.", "ver"], ["eaux", "oiç", "tion", "le"]]
    rows = []
    for i in range(300):
        own = rng.choice(kinds)
        rows.append((i, " ".join(rng.choice(own) + rng.choice(["", "", str(rng.randrange(30))]) for _ in range(rng.randrange(1, 150)))))
    return rows + [(400, None), (401, ""), (None, "null id"), rows[5], (402, "long mi " * 20000)]


@pytest.mark.parametrize("shard_bytes", [1 << 20, 9000])
def test_base_equals_brute_force_and_the_model_is_better(spark, shard_bytes):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, counts int").repartition(5)
    got = sorted(map(tuple, language_model(docs, shard_bytes).collect()), key=str)
    expected = brute(rows)
    assert [g[:5] for g in sorted(got, key=lambda r: str(r[:5]))] == [e[:5] for e in sorted(expected, key=lambda r: str(r[:5]))]
    base = lambda rs: sorted((str(r[0]), r[2], r[5]) for r in rs)
    assert all(abs(x[2] - y[2]) <= 1e-9 * max(1, abs(y[2])) for x, y in zip(base(got), base(expected)))
    held = [r for r in got if r[1]]
    assert len(held) > 20 and sum(r[6] for r in held) > 0.9 * sum(r[5] for r in held)


def test_nothing_to_learn_and_no_rows(spark):
    held = next(i for i in range(100) if fold(i) == 2)
    docs = spark.createDataFrame([(held, "a b")], "doc_id long, text string")
    (row,) = language_model(docs).collect()
    assert (row.train_tokens, row.n_tokens, row.n_known, row.base_score) == (0, 3, 0, 0) and abs(row.score + 3 * math.log10(CLASSES)) < 1e-6
    assert language_model(docs.limit(0)).collect() == []


def test_features_see_three_words_back_and_no_other_text():
    streams = [Stream(t) for t in chunks(pa.array([b"a b c d", b"", b"b c d e"]))]
    (s,) = streams
    assert s.sizes.tolist() == [5, 1, 5] and (s.back(1)[[0, 5, 6]] == START).all()
    assert s.back(3)[3] == s.tokens[0] and (s.back(3)[[0, 1, 2, 6, 7, 8]] == START).all()
    assert (s.features()[4] == s.features()[9]).all() and (s.features()[3] != s.features()[8]).any()


def test_gradient_steps_follow_the_likelihood():
    rng = random.Random(1)
    text = " ".join(rng.choice(["aa bb", "cc dd ee"]) for _ in range(4000)).encode()
    trainer, loss = Trainer(np.zeros((ROWS, CLASSES), np.float32)), []
    for _ in range(4):
        for texts in chunks(pa.array([text])):
            s = Stream(texts)
            loss.append(-log_softmax(trainer.weights, s.features())[np.arange(len(s.tokens)), s.classes].mean())
            trainer.steps(s, np.arange(len(s.tokens)))
    assert loss[-1] < 0.5 * loss[0]
    changes = trainer.changes()
    assert changes.num_rows == (trainer.met > 0).sum()
