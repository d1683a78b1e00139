"""Toxicity: a learned lexicon, matched in spite of misspelling, with quotation told from abuse.

1. Terms: words that labelled toxic documents hold far more often than the others, counted over every
   labelled training document, each distinct text once. All terms that chance does not explain are kept.
2. Matching: the terms are a trie. A Levenshtein automaton for each word of a text walks it, and leaves a
   branch as soon as no term below can be within the allowed distance. Misspelled terms weigh half. So do
   words that begin with a learned stem.
3. Context: a hit within quotation marks, or near a word that reports speech, counts apart from one that
   is the text's own.
4. A logistic model over the sums, fitted on a bounded sample of labelled training documents.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgermill.llm.jobs import by_batch, checkpointed, releasing, remainder

MIN_DOCS = 3
"""A term occurs in so many toxic documents at least."""

STEM, STEM_SIZES = "*", (4, 6, 8)
"""Beginnings of words are counted like words: a family of words may share what its members are too rare to show."""

SAMPLE_ROWS = 50_000
"""Bound of the labelled rows the model is fitted on, those of least hash."""

TOXIC_ROW = 5.0
"""A toxic document that is kept counts as so many others that are rejected."""

BROADCAST_LABELS = 2_000_000
"""Up to so many labels (16 bytes each) are broadcast; beyond, both sides are shuffled."""

BROADCAST_TEXTS = 2_000_000
"""Up to so many hashes of copied texts (16 bytes each) are broadcast; beyond, only those of many copies are."""

MANY_COPIES = 1_000

CACHE_WORDS = 200_000
"""Words whose match a task remembers."""

#: Words that report what others say.
REPORTS = frozenset(
    "said says say wrote writes write quote quoted quotes called calls saying according "
    "dit disait écrit selon appelé sagte sagt schrieb laut nannte dijo dice escribió según llamó".split()
)
#: Quotation marks that open, and what closes each.
MARKS = {'"': '"', "“": "”", "„": "“”", "«": "»", "»": "«", "‘": "’", "‹": "›"}
NEAR, QUOTED_WORDS = 4, 60
"""Words between a report and a hit; the longest quotation."""

TOKEN = re.compile(r"\w+|[\"“”„«»‘’‹›]")
WORD = re.compile(r"\w+")

FEATURES = ("own", "quoted", "misspelled", "heaviest", "different", "density")
"""Of the different hits: sums of weights of a text's own ones, quoted ones and own misspelled ones; the heaviest; how
many own ones; and all hits as a part of the words."""


def allowed(term: str) -> int:
    """Edits that still leave a term recognisable: none in short ones."""
    return 0 if len(term) < 5 else 1


class Node:
    """A node of the trie: the nodes below, and the term that ends here if it may be misspelled."""

    __slots__ = ("below", "term")

    def __init__(self):
        self.below: dict[str, Node] = {}
        self.term: str | None = None

    def follow(self, rest: str) -> str | None:
        """The term at the end of ``rest``."""
        node = self
        for c in rest:
            node = node.below.get(c)
            if node is None:
                return None
        return node.term


class Trie:
    """The lexicon: terms, and stems (marked by a star) that match words which begin with them."""

    def __init__(self, terms: dict[str, float]):
        self.stems = {t[:-1]: w for t, w in terms.items() if t.endswith(STEM)}
        self.stem_sizes = sorted({len(s) for s in self.stems}, reverse=True)
        self.terms, self.root = {t: w for t, w in terms.items() if not t.endswith(STEM)}, Node()
        # One edit leaves the first or the second half of a term as it is: words with neither need no walk.
        self.halves: dict[int, tuple[set[str], set[str]]] = {}
        for term in self.terms:
            if allowed(term):
                first, last = self.halves.setdefault(len(term), (set(), set()))
                first.add(term[: len(term) // 2])
                last.add(term[len(term) // 2 :])
                node = self.root
                for c in term:
                    node = node.below.setdefault(c, Node())
                node.term = term

    def match(self, word: str) -> tuple[float, int] | None:
        """Weight and edits of the nearest term; the heavier one on a tie; else of the longest stem, as one edit."""
        if word in self.terms:
            return self.terms[word], 0
        if self.has_half(word):
            found = self.one_edit(word)
            if found:
                return max(self.terms[t] for t in found), 1
        for n in self.stem_sizes:
            if len(word) > n and word[:n] in self.stems:
                return self.stems[word[:n]], 1
        return None

    def has_half(self, word: str) -> bool:
        for n in (len(word) - 1, len(word), len(word) + 1):
            halves = self.halves.get(n)
            if halves and (word[: n // 2] in halves[0] or word[n // 2 - n :] in halves[1]):
                return True
        return False

    def one_edit(self, word: str) -> set[str]:
        """The terms one edit away: the word's Levenshtein automaton and the trie, walked together.

        The automaton is in its first row as long as the trie has the word's own characters. From each
        place there, the edits lead to its second row, where the rest of the word must follow as it is.
        """
        found, node = set(), self.root
        for i in range(len(word) + 1):
            rest, after = word[i:], word[i + 1 :]
            for c, below in node.below.items():
                if not rest or rest[0] in below.below:  # the word lacks c
                    found.add(below.follow(rest))
                if rest and c != rest[0] and (not after or after[0] in below.below):  # another character for c
                    found.add(below.follow(after))
            if rest:
                found.add(node.follow(after))  # a character too many
                node = node.below.get(rest[0])
                if node is None:
                    break
        found.discard(None)
        return found


def quoted_places(tokens: list[str]) -> set[int]:
    """Places within quotation marks that close again within ``QUOTED_WORDS`` tokens."""
    inside, opened, closes = set(), None, ""
    for i, token in enumerate(tokens):
        if opened is not None and token in closes:
            inside.update(range(opened + 1, i))
            opened = None
        elif opened is not None and i - opened > QUOTED_WORDS:
            opened = None
        if opened is None and token in MARKS and not (closes and token in closes):
            opened, closes = i, MARKS[token]
        elif opened is None:
            closes = ""
    return inside


@dataclass(frozen=True)
class ToxicModel:
    terms: tuple[tuple[str, float], ...]
    weights: tuple[float, ...]
    center: tuple[float, ...]
    scale: tuple[float, ...]


def features(text: str | None, trie: Trie, known: dict) -> tuple[float, ...]:
    """The sums of one text; ``known`` remembers the matches of words."""
    lower = (text or "").lower()
    hits = []
    words = WORD.findall(lower)
    for word in set(words):
        found = known.get(word, 0)
        if found == 0:
            if len(known) >= CACHE_WORDS:
                known.clear()
            found = known[word] = trie.match(word)
        if found:
            hits.append(word)
    if not hits:
        return (0.0,) * len(FEATURES)
    tokens, hits = TOKEN.findall(lower), set(hits)
    quoted = quoted_places(tokens)
    own: dict[str, float] = {}
    others: dict[str, float] = {}
    misspelled = heaviest = 0.0
    n = 0
    for i, token in enumerate(tokens):
        if token in hits:
            weight, edits = known.get(token) or trie.match(token)
            weight /= 1 + edits
            n += 1
            heaviest = max(heaviest, weight)
            if i in quoted or not REPORTS.isdisjoint(tokens[max(0, i - NEAR) : i + NEAR + 1]):
                others[token] = weight
            else:
                if edits and token not in own:
                    misspelled += weight
                own[token] = weight
    return sum(own.values()), sum(others.values()), misspelled, heaviest, math.log1p(len(own)), n / max(1, len(words))


def with_labels(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` that carry a label ``toxic``; a document with several takes the largest."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    small = labels.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS
    return docs.join(F.broadcast(known) if small else known, "doc_id")


def training(column: str = "doc_id") -> Column:
    return remainder(column, 5) != 0


def counted_once(labelled: DataFrame) -> DataFrame:
    """text, toxic, weight: the rows of one text weigh 1 together, whatever their labels."""
    rows = labelled.withColumn("_text", F.xxhash64("text"))
    copies = checkpointed(rows.groupBy("_text").agg(F.count("*").alias("n")).filter("n > 1"))
    if copies.limit(BROADCAST_TEXTS + 1).count() <= BROADCAST_TEXTS:
        rows = rows.join(F.broadcast(copies), "_text", "left")
    else:
        # texts of many copies are few, and would be too many rows for the task they were dealt to
        many = copies.filter(F.col("n") > MANY_COPIES).withColumnRenamed("n", "many")
        dealt = rows.join(F.broadcast(many), "_text", "left")
        rest = dealt.filter("many is null").join(copies, "_text", "left").select("text", "toxic", "n")
        rows = rest.union(dealt.filter("many is not null").select("text", "toxic", F.col("many").alias("n")))
    return rows.select("text", "toxic", (F.lit(1.0) / F.coalesce("n", F.lit(1))).alias("weight"))


def learn_terms(labelled: DataFrame) -> dict[str, float]:
    """Terms and weights from (text, toxic): the log odds of a word to be in a toxic document.

    Words and beginnings of words count if chance would not give them to one of all words counted. Copies of a
    text share one count. Every task counts the words of its batches before the shuffle.
    """
    labelled = counted_once(labelled.select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic")))

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        toxic, clean = Counter(), Counter()
        for text, label, weight in zip(*(batch[c].to_pylist() for c in ("text", "toxic", "weight"))):
            words = set(WORD.findall((text or "").lower()))
            found = toxic if label else clean
            for n in STEM_SIZES:
                words |= {w[:n] + STEM for w in words if len(w) > n and not w.endswith(STEM)}
            for w in words:
                found[w] += weight
        words = sorted(toxic.keys() | clean.keys())
        return pa.RecordBatch.from_pydict(
            {"word": words, "toxic": [toxic[w] for w in words], "clean": [clean[w] for w in words]},
            pa.schema([("word", pa.string()), ("toxic", pa.float64()), ("clean", pa.float64())]),
        )

    totals = {r["toxic"]: r["n"] for r in labelled.groupBy((F.col("toxic") > 0).alias("toxic")).agg(F.round(F.sum("weight"), 6).alias("n")).collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    if not n_toxic:
        return {}
    counts = by_batch(labelled, count, "word string, toxic double, clean double")
    # rounded, so that the order of the sums does not show
    counts = counts.groupBy("word").agg(F.round(F.sum("toxic"), 6).alias("toxic"), F.round(F.sum("clean"), 6).alias("clean"))
    seen = Observation()
    counts = counts.observe(seen, F.count(F.lit(1)).alias("words"))
    # how unlikely so many toxic documents are by chance, as the exponent of a binomial's tail
    share, both = n_toxic / (n_toxic + n_clean), F.col("toxic") + F.col("clean")
    part = F.col("toxic") / both
    clean_part = F.when(F.col("clean") > 0, F.col("clean") * F.log((1 - part) / F.lit(1 - share + 1e-12))).otherwise(0.0)
    evidence = F.col("toxic") * F.log(part / F.lit(share)) + clean_part
    found = counts.filter((F.col("toxic") >= MIN_DOCS) & (F.length("word") >= 3) & (part > share))
    found = checkpointed(found.withColumn("evidence", evidence))
    odds = F.log((F.col("toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n_clean + 1.0))
    # as many words as there are must not give one by chance
    found = found.filter(F.col("evidence") >= math.log(max(2, seen.get["words"]))).withColumn("odds", odds)
    return {r["word"]: round(r["odds"], 6) for r in found.select("word", "odds").collect()}


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, toxic: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights (the first is the constant), centers and scales of a logistic model, by Newton steps.

    A row of label 1 counts as ``toxic`` rows.
    """
    center, scale = (x.mean(0), x.std(0)) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.hstack([np.ones((len(x), 1)), (x - center) / scale])
    w = np.zeros(z.shape[1])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1]) * max(1, len(x))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        each = np.where(y > 0, toxic, 1.0)
        step = np.linalg.solve((z * (each * p * (1 - p))[:, None]).T @ z + penalty, z.T @ (each * (y - p)) - penalty @ w)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w, center, scale


def text_features(docs: DataFrame, terms: tuple[tuple[str, float], ...], keys: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, known = Trie(dict(terms)), {}  # of this task: a worker holds nothing on to the next
        for batch in batches:
            found = list(zip(*(features(t, trie, known) for t in batch["text"].to_pylist()))) or [[]] * len(FEATURES)
            columns = [*(batch[k] for k in keys), *(pa.array(f, pa.float64()) for f in found)]
            yield pa.RecordBatch.from_arrays(columns, [*keys, *FEATURES])

    rows = docs.select(*keys, F.make_valid_utf8("text").alias("text"))
    return rows.mapInArrow(releasing(run), ", ".join([f"`{k}` long" for k in keys] + [f"{f} double" for f in FEATURES]))


def score_column(model: ToxicModel) -> Column:
    z = F.lit(model.weights[0])
    for name, w, c, s in zip(FEATURES, model.weights[1:], model.center, model.scale):
        z = z + F.lit(w) * (F.col(name) - F.lit(c)) / F.lit(s)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def toxicity(docs: DataFrame, labels: DataFrame, key: str | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs`` (doc_id, text), learned from ``labels``.

    With ``key``, a column of whole numbers, that column comes back too, so that rows of one id can be told apart.

    Learned only from rows outside the fold that ``held_out`` marks. Defined cases: null and empty texts
    have no hit and the score of a text without one; with no toxic label to learn from, no term is known
    and every score is the (smoothed) share of toxic labels. Null labels and ids teach nothing. Repeated
    rows give repeated results; extra columns are ignored.
    """
    keys = ["doc_id"] + ([key] if key else [])
    own = docs.select(*(F.col(k).cast("long").alias(k) for k in keys), F.make_valid_utf8(F.col("text").cast("string")).alias("text"))
    labelled = with_labels(own.filter(training()), labels.select("doc_id", "toxic"))
    terms = tuple(sorted(learn_terms(labelled).items()))
    scored = checkpointed(text_features(own, terms, keys))
    sample = with_labels(scored.filter(training()), labels.select("doc_id", "toxic"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id", *FEATURES).limit(SAMPLE_ROWS).select(*FEATURES, "toxic").collect()
    x = np.array([[r[f] for f in FEATURES] for r in sample], float).reshape(-1, len(FEATURES))
    y = np.array([float(r["toxic"] > 0) for r in sample])
    if not y.any():
        share = (y.sum() + 0.5) / (len(y) + 2)
        w, center, scale = np.array([math.log(share / (1 - share))] + [0.0] * len(FEATURES)), np.zeros(len(FEATURES)), np.ones(len(FEATURES))
    else:
        w, center, scale = fit(x, y, toxic=TOXIC_ROW)
    model = ToxicModel(terms, *(tuple(map(float, v)) for v in (w, center, scale)))
    score = scored.select(*keys, (remainder("doc_id", 5) == 0).alias("held_out"), score_column(model).alias("score"))
    return score.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int"))
