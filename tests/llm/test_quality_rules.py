import random
import re

from ledgermill.llm.quality_rules import CUTOFF, MIN_GROUP, quality_rules

WORD = r"[^\x20\x09-\x0D]+"


def brute(text):
    text = text or ""
    words = re.findall(WORD, text)
    seen = {}
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    covered = {p for places in seen.values() if len(places) > 1 for s in places for p in range(s, s + 3)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def corpus():
    rng = random.Random(10)
    rows = []
    for i in range(500):
        words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(20, 200))]
        if i % 3 == 0:
            at = rng.randrange(len(words))
            words[at:at] = words[at : at + rng.randrange(40)]
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\t"]) for w in words)
        if i % 5 == 0:
            text += "\n" + "same line\n" * rng.randrange(4) + " \n" * 3
        rows.append((i, text, rng.choice(["en", "de"]), "src0" if rng.random() < 0.5 else f"src{i % 3}"))
    junk = ["$$$ *** ### " * 100 + " ".join(map(str, range(300))), " ".join(f"{i}{'x' * 60}" for i in range(100))]
    rows += [(900 + k, t, "en", "src0") for k, t in enumerate(junk)]
    rows += [(None, None, None, None), (950, "", "en", None), (951, "  \x0b a\n\x0b\n" * 30, None, "src0"), rows[3], (952, "b " * 30000, "en", "src0")]
    return rows


def test_base_equals_brute_force_and_outliers_go(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, source string, h double")
    got = quality_rules(docs).collect()
    assert sorted([tuple(r)[:7] for r in got], key=str) == sorted([(d, *brute(t)) for d, t, _, _ in rows], key=str)
    assert all(not r.kept for r in got if r.base_failed or r.doc_id in (900, 901))
    good = [r for r in got if not r.base_failed and r.doc_id is not None and r.doc_id < 900]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert all(r.kept == (r.distance is None or r.distance <= CUTOFF) for r in got if not r.base_failed)


def test_small_groups_and_no_rows(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(60)), "en", "s") for i in range(MIN_GROUP - 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert all(r.kept and r.distance is None for r in quality_rules(docs).collect())
    assert quality_rules(docs.limit(0)).collect() == []


def test_junk_in_small_groups_goes(spark):
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(2, 9))) for _ in range(n))
    rows = [(i, words(rng.randrange(60, 200)), "en", "large" if i < 2 * MIN_GROUP else f"site{i}") for i in range(3 * MIN_GROUP)]
    rows += [(500 + i, words(100), lang, "s") for i, lang in enumerate(["fr", "fr", None])]
    # in a small group of a large language, in a language of few rows, and without either
    junk = [(600 + i, words(60) + " $$$" * 60, lang, source) for i, (lang, source) in enumerate([("en", "site90"), ("fr", "s"), (None, None)])]
    docs = spark.createDataFrame(rows + junk, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert len(got) == len(rows + junk) and all(r.distance is not None for r in got.values())
    assert {d for d, r in got.items() if not r.kept} == {600, 601, 602}


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a", "en", "s")], "doc_id long, text string, lang string, source string")
    plan = quality_rules(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
