import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from ledgermill.llm import decontamination
from ledgermill.llm.decontamination import Items, leaks, without_leaks


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def shingles(words, size):
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(docs, items):
    out = []
    for d, text in docs:
        words = words_of(text)
        for item_id, item in sorted(set(items), key=str):
            own = words_of(item)
            if not own:
                continue
            size = min(5, len(own))
            target, best = shingles(own, size), None
            n = min(len(own), len(words))
            for s in range(len(words) - n + 1 if n >= size else 0):
                found = shingles(words[s : s + n], size)
                both = sum((found & target).values())
                value = both / (sum(found.values()) + sum(target.values()) - both)
                if value >= 0.75 and (best is None or value > best[2]):
                    best = (s, n, value)
            if best:
                out.append((d, item_id, *best))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(8)
    word = lambda: rng.choice("abcd") + str(rng.randrange(40))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 12, 30, 31, 70])))) for i in range(25)]
    items += [(90, "x x x x x x x x x"), (91, ""), (92, None), (None, "the null item of six words"), items[0]]
    docs = []
    for i in range(150):
        words = [word() for _ in range(rng.randrange(120))]
        for _ in range(rng.randrange(3)):
            leak = words_of(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2]) * len(leak) // 30):
                leak[rng.randrange(len(leak))] = word()
            at = rng.randrange(len(words) + 1)
            words[at:at] = leak
        docs.append((i, " ".join(words).upper() if i % 7 == 0 else "\n".join(words)))
    docs += [(200, items[5][1]), (201, " ".join(items[6][1].split()[:-2])), (202, "x " * 30), (203, None), (204, ""), (None, items[4][1]), docs[3]]
    return docs + [(205, "y " * 4000 + items[6][1] + " z" * 4000)], items


@pytest.mark.parametrize("item_bytes", [1 << 20, 300])
def test_equals_brute_force(spark, item_bytes):
    docs, items = corpus()
    frame = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item_id int").repartition(4)
    benchmark = spark.createDataFrame([(*i, "t") for i in items], "item_id long, text string, doc_id string")
    expected = brute(docs, items)
    assert len(expected) > 60
    got = sorted(map(tuple, leaks(frame, benchmark, item_bytes).collect()), key=str)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert all(abs(g[4] - e[4]) < 1e-12 for g, e in zip(got, expected))
    left = without_leaks(frame, benchmark, item_bytes).collect()
    bad = {d for d, *_ in expected}
    assert sorted(map(str, left)) == sorted(str(r) for r in frame.collect() if r.doc_id not in bad)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    assert leaks(docs.limit(0), items).collect() == []
    assert leaks(docs, items.limit(0)).collect() == [] and without_leaks(docs, items.limit(0)).count() == 1
    assert without_leaks(docs, items).count() == 0


def test_blocks_find_all_within_the_radius():
    rng = random.Random(9)
    items = Items([(i, " ".join(str(rng.random()) for _ in range(20)).encode()) for i in range(50)])
    (length,) = items.lengths
    import numpy as np

    found = np.array([rng.getrandbits(64) for _ in range(2000)] + [int(f) ^ (1 << rng.randrange(64)) for f in length.fingerprints], np.uint64)
    which, item = length.within_radius(found)
    distance = np.bitwise_count(found[:, None] ^ length.fingerprints[None, :])
    assert set(zip(which.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(distance <= 23))))


def test_stretches_of_a_text_give_what_the_whole_does(monkeypatch):
    docs, items = corpus()
    column = pa.array([t.encode() if t is not None else None for _, t in docs], pa.binary())
    block = Items([(i, (t or "").encode()) for i, t in items])
    whole = sorted(block.matches(column), key=str)
    for stretch in (3, 50):
        monkeypatch.setattr(decontamination, "STRETCH", stretch)
        assert sorted(block.matches(column), key=str) == whole
    assert len(whole) > 50
