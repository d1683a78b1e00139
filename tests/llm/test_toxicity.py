import random
import string
import zlib

import pytest

from ledgermill.llm.toxicity import FEATURES, Trie, allowed, features, learn_terms, quoted_places, toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, d in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (c != d))
    return row[-1]


def test_walk_equals_distances_to_every_term():
    rng = random.Random(1)
    word = lambda n: "".join(rng.choice("abcd") for _ in range(n))
    terms = {word(rng.randrange(3, 13)): float(i) for i in range(40)}
    trie = Trie(terms)
    for _ in range(3000):
        text = list(rng.choice(list(terms)) if rng.random() < 0.7 else word(rng.randrange(3, 14)))
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(text) + 1)
            text[at : at + rng.randrange(2)] = rng.choice(["", "a", "b", "x"])
        text = "".join(text)
        near = [(distance(text, t), -w) for t, w in terms.items() if distance(text, t) <= allowed(t)]
        if text in terms:
            assert trie.match(text) == (terms[text], 0)
        elif len(text) < 4:
            assert trie.match(text) is None
        else:
            assert trie.match(text) == ((-min(near)[1], min(near)[0]) if near else None), text


def test_stems_match_beginnings():
    trie = Trie({"wort*": 2.0, "worthy": 5.0})
    assert trie.match("wortx") == (2.0, 1) and trie.match("worthy") == (5.0, 0) and trie.match("wort") is None


def test_quotes_and_reports_are_told_apart():
    def sums(text):
        return dict(zip(FEATURES, features(text, Trie({"rotten": 5.0}), {})))

    own, quoted, wrong = map(sums, ("you rotten thing", 'a "very rotten" b', "rottten"))
    assert own["own"] > 0 == own["quoted"] and quoted["quoted"] > 0 == quoted["own"] and wrong["misspelled"] > 0
    assert sums("she said rotten")["own"] == 0
    assert sums(None) == sums("") == sums("a b") == dict.fromkeys(FEATURES, 0.0)
    assert quoted_places(['"', "a", '"', "b", "«", "c", "»", '"', "d"]) == {1, 5}


def corpus(n):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice(string.ascii_lowercase[:9]) for _ in range(rng.randrange(2, 8)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randrange(3, 40))]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(["zounds", "yuckfoo", "wretchx"])
        docs.append((i, " ".join(words), i))
        labels.append((i, int(toxic), None))
    return docs, labels


def test_held_out_accuracy_and_defined_cases(spark):
    rows, marks = corpus(600)
    extra = [(None, None, 0), (7000, "", 0), (7001, "ZOUNDS!", 0), (7002, "zoundss " * 5000, 0), (7002, "zoundss " * 5000, 0)]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score int")
    labels = spark.createDataFrame(marks + [(None, 1, 0), (3, None, 0)], "doc_id long, toxic int, quality int")
    got = [r.asDict() for r in toxicity(docs, labels).collect()]
    assert len(got) == 605
    by_id = {r["doc_id"]: r for r in got}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got if r["doc_id"] is not None)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [(by_id[i]["predicted"], m) for i, m, _ in marks if by_id[i]["held_out"]]
    assert sum(p == m for p, m in held) >= 0.98 * len(held)
    assert by_id[7001]["predicted"] == 1 and by_id[7002]["predicted"] == 1 and by_id[7000]["predicted"] == 0


@pytest.mark.parametrize("marks", [[], [(1, 0, 0)]])
def test_nothing_to_learn(spark, marks):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality int")
    assert [r.predicted for r in toxicity(docs, labels).collect()] == [0, 0]
    assert toxicity(docs.limit(0), labels).collect() == []


def test_all_terms_are_kept_and_copies_count_once(spark):
    terms = {f"{a}{b}{c}" for a in "bcdfghklmnprst" for b in string.ascii_lowercase for c in string.ascii_lowercase[:13]}
    rows = [(f"{' '.join(sorted(terms))} only{i}", 1) for i in range(40)] + [(f"calm{i}", 0) for i in range(40)]
    rows += [("copied message", 1)] * 40
    found = learn_terms(spark.createDataFrame(rows, "text string, toxic int"))
    assert len(terms) > 4000 and terms <= found.keys()
    assert not {"copied", "message"} & found.keys()
