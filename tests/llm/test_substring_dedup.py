import hashlib
import random

import pytest

from ledgermill.llm.substring_dedup import substring_dedup


def brute(rows, window):
    """Every window of every row against every earlier one."""
    texts = [(d if d is not None else -(1 << 63), (t or "").encode().split()) for d, t in rows]
    out = []
    for i, (d, words) in enumerate(texts):
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            w = words[s : s + window]
            earlier = any(e < d and any(v[k : k + window] == w for k in range(len(v) - window + 1)) for e, v in texts)
            if earlier or any(words[k : k + window] == w for k in range(s)):
                gone[s : s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(words, gone) if not g)
        out.append((rows[i][0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["aa", "b", "ç", "dd d", "E", "ff"])
    passage = [word() for _ in range(40)]
    rows = []
    for i in range(60):
        words = [word() + str(rng.randrange(30)) for _ in range(rng.randrange(60))]
        at = rng.randrange(len(words) + 1)
        cut = rng.randrange(30)
        words[at:at] = passage[cut : cut + rng.randrange(35)] * rng.choice([0, 1, 1, 2])
        rows.append((i, rng.choice([" ", "\n", "\t \x0b"]).join(words)))
    rows += [(60, rows[3][1]), (61, rows[3][1]), (62, "x " * 70), (63, ""), (64, None), (65, " \n")]
    rows += [(7, rows[7][1]), (8, rows[9][1]), (None, rows[11][1]), (None, None)]
    return rows


@pytest.mark.parametrize("window,shard_bytes", [(20, 1 << 20), (20, 700), (8, 900), (3, 2000), (1, 2000)])
def test_equals_brute_force(spark, window, shard_bytes):
    rows = corpus(window)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup(docs, window, shard_bytes=shard_bytes).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, window)


def test_carried_columns_and_text(spark):
    docs = spark.createDataFrame(
        [(1, "a  b\nc d", 5, "s"), (2, "z a b c y", 6, None), (3, None, None, "t")],
        "doc_id long, text string, shard int, carried string",
    )
    got = {r.doc_id: r for r in substring_dedup(docs, 3, carry=["shard", "carried"]).collect()}
    assert got[1].kept_text == b"a  b\nc d" and got[2].kept_text == b"z y" and got[3].kept_text is None
    assert got[2].carried.shard == 6 and got[3].carried.carried == "t"


def test_empty_table(spark):
    assert substring_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []
