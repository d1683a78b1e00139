"""Each stage on what the one before it wrote, against plain Python, and the whole run."""

import re

import corpus_pipeline
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_decontamination import brute as leaks_of
from test_minhash import brute as groups_of
from test_tokens import best_fit, whole
from test_toxicity import corpus

from ledgermill.llm.toxicity import toxicity

FOLDER = "/root/testdata/sf0.001"
NAMES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before each stage, and the result of the last."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append(docs)
        stage(spark, docs, FOLDER).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
    return [*out, docs]


def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_columns_stay_until_the_last(stages):
    assert NAMES == ["toxicity", "near_duplicates", "substring_dedup", "decontamination", "packing"]
    assert all(d.dtypes == stages[0].dtypes for d in stages[:-1])
    assert stages[-1].columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_toxic_documents_go(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    rejected = {r.doc_id for r in toxicity(stages[0], labels).filter("predicted = 1").collect()}
    assert texts(stages[1]) == {d: t for d, t in texts(stages[0]).items() if d not in rejected}


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    kept = {d for d, _, _, keep in groups_of(list(before.items())) if keep}
    assert texts(stages[2]) == {d: t for d, t in before.items() if d in kept} and len(kept) < len(before)


def test_repeats_are_cut(stages):
    before, seen, expected = texts(stages[2]), set(), {}
    for d in sorted(before):
        words = re.findall(r"[^\x20\x09-\x0D]+", before[d] or "")
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            if tuple(words[s : s + 20]) in seen:
                gone[s : s + 20] = [True] * 20
            seen.add(tuple(words[s : s + 20]))
        expected[d] = " ".join(w for w, g in zip(words, gone) if not g) if any(gone) else before[d]
    assert texts(stages[3]) == expected and expected != before
    assert stages[3].filter(F.length("text") != F.col("n_chars")).join(stages[2], ["doc_id", "text", "n_chars"], "left_anti").count() == 0


def test_leaks_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    before = texts(stages[3])
    bad = {d for d, *_ in leaks_of(list(before.items()), items)}
    assert bad and texts(stages[4]) == {d: t for d, t in before.items() if d not in bad}


def test_packed_whole(stages):
    lengths = []
    for t in texts(stages[4]).values():
        n = len(whole("byte_bpe_50k.json", t)) + 1
        lengths += ([n % 1024] if n % 1024 else []) + [1024] * (n // 1024)
    rows = stages[5].collect()
    assert sorted(r.length for r in rows) == sorted(lengths)
    assert len({r.sequence_id for r in rows}) == best_fit(lengths, 1024)
    assert public_tokenizers.path("byte_bpe_50k.json")


def test_run_equals_the_stages(spark, stages):
    pieces = lambda df: sorted(tuple(r)[:5] for r in df.collect())
    assert pieces(corpus_pipeline.run(spark, FOLDER)) == pieces(stages[-1])


def test_nulls_and_no_rows(spark, stages):
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        odd = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (2, "", "en", "s", 0)], stages[0].schema)
        assert stage(spark, odd, FOLDER).count() == 3, name
        assert stage(spark, odd.limit(0), FOLDER).count() == 0, name


def test_rows_of_null_and_repeated_ids_are_decided_alone(spark, tmp_path):
    stage, many = dict(corpus_pipeline.STAGES), 10**9
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows, marks = corpus(600)
    spark.createDataFrame(marks, "doc_id long, toxic int, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    added = [(i, t, "en", "added", len(t)) for i in (None, many) for t in ("zounds", "yuckfoo", "abc")]
    known = [(i, t, "en", "s", len(t)) for i, t, _ in rows]
    got = stage["toxicity"](spark, spark.createDataFrame(known + added, schema), str(tmp_path)).filter("source = 'added'")
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(None, "abc"), (many, "abc")], key=str)

    words = lambda c, n=60: " ".join(f"{c}{i}" for i in range(n))
    docs = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], schema)
    copies = docs([(None, words("a")), (None, words("a")), (many, words("b")), (many, words("b")), (many, words("c")), (many + 1, words("a")), (many + 1, words("c"))])
    got = [(r.doc_id, r.text) for r in stage["near_duplicates"](spark, copies, FOLDER).collect()]
    assert sorted(got, key=str) == sorted([(None, words("a")), (many, words("b")), (many, words("c"))], key=str)

    repeats = docs([(i, f"{words(c, 30)} {words(f'{c}{k}', 30)}") for i, c in ((None, "a"), (many, "b")) for k in "xy"])
    got = [r.text for r in stage["substring_dedup"](spark, repeats, FOLDER).collect()]
    assert len(got) == 4 and [sum(words(c, 30) in t for t in got) for c in "ab"] == [1, 1]
    assert all(sum(words(f"{c}{k}", 30) in t for t in got) == 1 for c in "ab" for k in "xy")
