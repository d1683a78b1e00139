import random

from ledgermill.llm.language_id import PASSAGE_CHARS, SPARE, language_id, learn_dictionaries, letters

SYLLABLES = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["schr", "eng", "ung", "ö"], "cc": ["eau", "oi", "ç", "tion"]}


def corpus(n):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        words = ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(8, 300))]
        rows.append((i, " ".join(words).upper() if i % 9 == 0 else " ".join(words), lang, "s"))
    return rows


SCHEMA = "doc_id long, text string, lang string, rejected string"


def test_held_out_accuracy_and_defined_cases(spark):
    rows = corpus(300)
    extra = [(900, None, None, None), (901, "", None, None), (902, "12 !? _", None, None), (None, "schrengung eng ungö schrung engschr ung öeng schrschr ungung ö", None, None)]
    extra += [(903, "eau oi " * 40000, "zz", None), (903, "eau oi " * 40000, None, None)]
    docs = spark.createDataFrame(rows + extra, SCHEMA)
    dictionaries = learn_dictionaries(spark.createDataFrame(rows[:150], SCHEMA))
    assert set(dictionaries) == set(SYLLABLES)
    got = language_id(docs, dictionaries).collect()
    assert len(got) == len(rows) + len(extra)
    by_id = {r.doc_id: r for r in got}
    right = sum(by_id[i].lang_pred == lang for i, _, lang, _ in rows[150:])
    assert right >= 0.99 * 150
    assert [by_id[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by_id[903].lang_pred == "cc" and by_id[None].lang_pred == "bb"
    assert all(0 <= r.score <= 1 for r in got) and by_id[900].rejected


def test_nothing_learned_and_bounds(spark):
    docs = spark.createDataFrame([(1, "abc", None, None)], SCHEMA)
    assert learn_dictionaries(docs) == {}
    assert [r.lang_pred for r in language_id(docs, {}).collect()] == ["und"]
    assert [r.score for r in language_id(docs, {"aa": b"abc abd"}).collect()] == [1.0]
    assert language_id(docs.limit(0), {"aa": b"abc"}).collect() == []
    many = spark.createDataFrame([(i, "abc " * 900, "aa", None) for i in range(50)], SCHEMA)
    assert len(learn_dictionaries(many, size=1000)["aa"]) == 1000


def test_letters_are_letters():
    assert [letters(t) for t in ("½ ² ①", "Ⅷ", "x²y", "Ä-é", "ʰ")] == ["", "", "x y", "ä é", "ʰ"]


def test_no_letter_is_und(spark):
    docs = spark.createDataFrame([(1, "½ ² ① Ⅷ", None, None), (2, "a½", None, None)], SCHEMA)
    assert {r.doc_id: r.lang_pred for r in language_id(docs, {"aa": b"abc"}).collect()} == {1: "und", 2: "aa"}


def test_a_tie_goes_to_the_more_frequent_language(spark):
    rows = [(i, "same words here", "bb" if i < 7 else "aa", None) for i in range(10)]
    dictionaries = learn_dictionaries(spark.createDataFrame(rows, SCHEMA))
    assert list(dictionaries) == ["bb", "aa"]
    found = language_id(spark.createDataFrame([(1, "same words", None, None)], SCHEMA), dictionaries).first()
    assert (found.lang_pred, found.rejected) == ("bb", True)


def test_passages_are_few_and_from_anywhere(spark):
    """One id in very many rows: what is read stays bounded; repeated rows count once; all parts of long texts teach."""
    texts = spark.range(4_000).selectExpr(
        "5L AS doc_id", "if(id % 2 = 0, repeat('kalo ', 500), concat(repeat('schrung ', 300), id)) AS text", "if(id % 2 = 0, 'aa', 'bb') AS lang"
    )
    found = learn_dictionaries(texts, size=20 * PASSAGE_CHARS)
    assert len(found["aa"]) <= PASSAGE_CHARS  # one passage: its rows are equal
    assert 10 * PASSAGE_CHARS < len(found["bb"]) <= 20 * PASSAGE_CHARS
    parted = spark.range(3_000).selectExpr("id AS doc_id", "concat(repeat('kalo ', 400), repeat('mitu ', 400)) AS text", "'aa' AS lang")
    taught = learn_dictionaries(parted)["aa"]
    assert abs(taught.count(b"kalo") - taught.count(b"mitu")) < 0.2 * taught.count(b"kalo") and SPARE > 1
