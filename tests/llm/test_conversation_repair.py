import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from ledgermill.llm import conversation_repair
from ledgermill.llm.conversation_repair import STOP, damaged, repair, repair_report, walk

COLUMNS = "conv_id long, turn long, role string, text string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults_of(rows):
    """Of (role, text) in order."""
    out, seen = [], set()
    for role, text in rows:
        seen_before = (role, text) in seen
        seen.add((role, text))
        shown = re.sub(r"[\x20\x09-\x0D]", "", text)
        out.append("blank" if not shown else "duplicate" if seen_before else "truncated" if shown[-1] not in ".!?" else "")
    return out


def cheapest(rows, faults):
    """Dijkstra over (rows done, initials so far as a state): least (cost, letters), with the repaired rows."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, state, made = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, letters, made
        if (i, state) in done:
            continue
        done.add((i, state))
        for role in ("user", "assistant"):
            if role[0] in follow[state]:
                heapq.heappush(heap, (cost + 3, letters + "I", i, role[0], (*made, (role, ""))))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, state, made))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] and role[:1] in follow[state]:
                    heapq.heappush(heap, (cost + more, letters + "K", i + 1, role[0], (*made, (role, text))))
                for other in ("user", "assistant"):
                    if other[0] in follow[state]:
                        heapq.heappush(heap, (cost + 3 + more, letters + "R", i + 1, other[0], (*made, (other, text))))


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.md5(text.encode()).digest())


def brute(original, rows):
    out = []
    for conv in {r[0] for r in original}:
        own = sorted((r for r in rows if r[0] == conv), key=order)
        turns = [r[1] for r in own if r[1] is not None]
        pairs = [r[2:] for r in own]
        faults = faults_of(pairs)
        cost, audit, made = cheapest(pairs, faults)
        heads = [role[:1] for role, _ in pairs]
        out.append((
            conv,
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(heads, heads[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def corpus(seed, n=120):
    rng, rows = random.Random(seed), []
    for conv in [*range(n), None]:
        for turn in range(rng.choice([1, 2, 3, 6, 9, 30])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "User", "", None])
            text = rng.choice(["Yes.", "No", "Ä! \n", " \t", "", None, "no. more", "Why?", f"It is {rng.randrange(40)}."])
            at = rng.choice([turn, turn, turn, turn + 5, None, turn - 1])
            rows += [(conv, at, role, text)] * rng.choice([1, 1, 1, 1, 2])
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment", [conversation_repair.SEGMENT, 1, 4])
def test_report_equals_brute_force(spark, monkeypatch, segment):
    monkeypatch.setattr(conversation_repair, "SEGMENT", segment)
    rows = corpus(segment)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], COLUMNS + ", key int, mark string").repartition(5)
    hurt = damaged(frame)
    assert sorted(map(tuple, hurt.collect()), key=str) == sorted(damage(rows), key=str)
    assert sorted(map(tuple, repair_report(frame, hurt).collect()), key=str) == brute(rows, damage(rows))


def test_undamaged_rows_and_their_edits(spark):
    rows = [(1, 0, "system", "Go."), (1, 1, "user", "A?"), (1, 2, "tool", "B."), (1, 3, "user", "C"), (2, 0, "assistant", "B.")]
    edits, _ = repair(spark.createDataFrame(rows, COLUMNS))
    got = sorted((r.key, r.row, r.step, r.edit, r.role, r.text) for r in edits.collect())
    assert [g for g in got if g[0] == "=1"] == [
        ("=1", 0, 0, "K", "system", "Go."),
        ("=1", 1, 0, "K", "user", "A?"),
        ("=1", 2, 0, "R", "assistant", "B."),
        ("=1", 3, 0, "D", None, None),
    ]
    assert [g[3:] for g in got if g[0] == "=2"] == [("I", "user", ""), ("K", "assistant", "B.")]


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "SEGMENT", 64)
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No", f"It is {t}."])) for t in range(3_000)]
    rows += [(8, 0, "user", "Same.")] * 500
    frame = spark.createDataFrame(rows, COLUMNS).repartition(6)
    assert sorted(map(tuple, repair_report(frame, frame).collect()), key=str) == brute(rows, rows)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert repair_report(empty, damaged(empty)).collect() == []


def test_everything_dropped(spark):
    turn = next(t for t in itertools.count() if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(1, turn, "user", "Hello.")], COLUMNS)
    assert list(map(tuple, repair_report(frame, damaged(frame)).collect())) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


def test_walk_in_blocks_is_one_walk():
    rng = random.Random(3)
    for n in (1, 2, 7, 50, 400):
        symbols = "".join(chr(65 + rng.randrange(16)) for _ in range(n))
        done, state = walk(symbols, STOP, 0, True)
        assert len(done) == n and state in (0, 3)
