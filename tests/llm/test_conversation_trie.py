import hashlib
import random
import re
import zlib

import pytest

from ledgermill.llm import conversation_trie
from ledgermill.llm.conversation_trie import prefix_trie, rebuilt, turns_of

COLUMNS = "conv_id long, turn long, role string, text string"


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.md5(text.encode()).hexdigest())


def rebuild(rows):
    rows = [(c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    own = {c: [r[2:] for r in sorted((r for r in rows if r[0] == c), key=order)] for c in {r[0] for r in rows}}
    taken = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    donor = {c: c - (abs(c) % 20) * (1 if c >= 0 else -1) for c in own}
    return {c: own.get(donor[c], [])[: taken[c]] + own[c][taken[c] :] for c in own}


def brute(convs):
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in nodes}
    for p in nodes:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in nodes}, {p: 0 for p in nodes}
    for p, members in nodes.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(members) - 1) * words
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(convs[c]) == len(p))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p], sha))
    return sorted(out)


def corpus(seed, n=150):
    """Copies, branches at every depth, conversations that end where others go on, and odd cells."""
    rng, rows = random.Random(seed), []
    trunk = [("user" if i % 2 == 0 else "assistant", " ".join(["w"] * rng.randrange(5)) + f" {i}") for i in range(40)]
    ids = [*range(-30, n - 60), *rng.sample(range(1_000, 9_000), 30)]
    for conv in ids:
        turns = trunk[: rng.choice([0, 1, 3, 8, 9, 16, 17, 24, 40])]
        turns = turns + [(rng.choice(["user", "tool", None]), rng.choice(["x y", "", None, f"z {rng.randrange(3)}"])) for _ in range(rng.choice([0, 0, 1, 2, 10]))]
        rows += [(conv, t if rng.random() < 0.98 else None, *turn) for t, turn in enumerate(turns)]
    rows += [(None, 0, "user", "a"), (None, None, None, None), rows[0], rows[5]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("segment", "block"), [(conversation_trie.SEGMENT, conversation_trie.BLOCK), (4, 2), (6, 3)])
def test_nodes_equal_brute_force(spark, monkeypatch, segment, block):
    monkeypatch.setattr(conversation_trie, "SEGMENT", segment)
    monkeypatch.setattr(conversation_trie, "BLOCK", block)
    monkeypatch.setattr(conversation_trie, "IDS_AT_ONCE", 3)
    rows = corpus(segment)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS + ", key string, index long").repartition(5)
    found = prefix_trie(*rebuilt(turns_of(frame)))
    expected = brute(rebuild(rows))
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == expected
    assert any(r[3] > 1 and r[4] > 1 for r in expected)


def test_many_copies_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "SEGMENT", 64)
    rows = [(c, t, "user", f"turn {t}") for c in range(300, 700) for t in range(4)]
    rows += [(c, t, "user", f"turn {t}") for c in (260, 280) for t in range(700 + c)]
    frame = spark.createDataFrame(rows, COLUMNS).repartition(6)
    turns = turns_of(frame)
    found = prefix_trie(turns, turns.select("conv_id").distinct())
    own = {c: [r[2:] for r in rows if r[0] == c] for c in {r[0] for r in rows}}
    assert sorted(map(tuple, found.collect()), key=lambda r: r[:2]) == brute(own)


def test_turnless_and_empty(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert prefix_trie(*rebuilt(turns_of(empty))).collect() == []
    conv = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    alone = spark.createDataFrame([(conv, 0, "user", "Hello there.")], COLUMNS)
    sha = hashlib.sha256(str(conv).encode()).hexdigest()
    assert list(map(tuple, prefix_trie(*rebuilt(turns_of(alone))).collect())) == [(conv, 0, None, 1, 0, 1, 0, sha)]


def test_first_repeats_share_one_node_when_blocks_agree(spark):
    """Blocks with one way on are not opened apart: their turns carry the members of the block."""
    rows = [(c, t, "user", f"{t}" if t < 12 else f"{c}") for c in (1, 2, 3) for t in range(13)]
    turns = turns_of(spark.createDataFrame(rows, COLUMNS))
    nodes = {(r.depth, r.conv_id): r.n_convs for r in prefix_trie(turns, turns.select("conv_id").distinct()).collect()}
    assert all(nodes[d, 1] == 3 for d in range(13)) and sum(d == 13 for d, _ in nodes) == 3
