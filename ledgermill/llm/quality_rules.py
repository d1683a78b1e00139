"""Quality rules: robust multivariate outliers, in DataFrame functions alone.

Base statistics come from whole texts: word windows are hashed, sorted and compared within the row, so no
window is shuffled. For every language and source, a minimum-covariance-determinant estimate of the
transformed statistics is found by concentration steps: from medians and quartiles, then again and again
from the ``SUPPORT`` part of the rows that lie nearest by Mahalanobis distance. A row far outside its
group's estimate is rejected. Groups reach the estimate only as sums and counts per distance bin, so a
source with a third of all rows costs no more than any other. A source too small for an estimate of its
own is judged by its language's, a language too small by that of all rows.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm.jobs import checkpointed

WHITE = " \t\n\x0b\x0c\r"
SPLIT = r"[\x20\x09-\x0D]+"

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

#: Transformed statistics and the least standard deviation that a group is taken to have in each: of
#: statistics that are 0 in nearly all texts, the estimate alone would reject the first that is not.
FLOORS = {"log_words": 0.3, "word_length": 0.25, "symbols": 0.1, "dup_lines": 0.1, "repeats": 0.08}

SUPPORT, STEPS = 0.75, 3
"""Part of a group that an estimate is made of, and how often it is improved."""

CUTOFF = 52.0
"""Squared distance from which a row is an outlier; under a normal law with 5 statistics, one in 10^9 is."""

MEDIAN_CHI2 = 4.351
"""Median of chi squared with 5 degrees of freedom: scales distances to those of a normal law."""

MIN_GROUP = 40
"""Groups of fewer rows have no estimate of their own; their rows are judged by a pooled one."""

ANY = "any"
"""The language or source of a pool; those of rows begin with "=" or are "null"."""

BINS_PER_OCTAVE = 16
BROADCAST_GROUPS = 50_000
"""Up to so many groups (about 400 bytes each) are broadcast."""

NAMES = tuple(FLOORS)


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, language, origin, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of every row."""
    group = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        group("lang").alias("language"),
        group("source").alias("origin"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"),
    )
    trimmed = F.btrim("t", F.lit(WHITE))
    rows = rows.withColumns(
        {
            "w": F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPLIT)),
            "lines": F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != ""),
            "n_symbols": F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long"),
        }
    ).drop("t")
    rows = rows.withColumns(
        {
            "n_words": F.size("w").cast("long"),
            "word_chars": F.length(F.array_join("w", "")).cast("long"),
            "n_lines": F.size("lines").cast("long"),
            "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
            "h": F.expr("if(size(w) < 3, cast(array() as array<bigint>), transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])))"),
        }
    ).drop("w", "lines")
    # windows by hash: those beside an equal one are repeated
    rows = rows.withColumn(
        "s", F.expr("if(size(array_distinct(h)) = size(h), cast(array() as array<struct<x:bigint,i:int>>), sort_array(transform(h, (x, i) -> struct(x, i))))")
    ).drop("h")
    rows = rows.withColumn(
        "starts", F.expr("sort_array(transform(filter(s, (a, k) -> (k > 0 and s[k - 1].x = a.x) or (k < size(s) - 1 and s[k + 1].x = a.x)), a -> a.i))")
    ).drop("s")
    # each start adds the words that the one before it does not cover
    covered = F.expr("aggregate(starts, struct(0L as n, -3 as p), (a, i) -> struct(a.n + least(3, i - a.p) as n, i as p), a -> a.n)")
    return rows.withColumn("n_repeat_words", covered).drop("starts")


def transformed() -> dict[str, Column]:
    """Statistics of comparable scale: logarithms of sizes, square roots of shares."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "log_words": F.log1p("n_words"),
        "word_length": F.col("word_chars") / words,
        "symbols": F.sqrt(F.least(F.col("n_symbols") / words, F.lit(4.0))),
        "dup_lines": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
        "repeats": F.sqrt(F.col("n_repeat_words") / words),
    }


def start(rows: DataFrame) -> DataFrame:
    """Per group: medians, and quartiles as standard deviations."""
    quartiles = [F.percentile_approx(n, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000).alias(f"q_{n}") for n in NAMES]
    groups = rows.groupBy("language", "origin").agg(F.count("*").alias("size"), *quartiles)
    out = {f"m_{n}": F.col(f"q_{n}")[1] for n in NAMES}
    for i, j in combinations_with_replacement(range(len(NAMES)), 2):
        q = F.col(f"q_{NAMES[i]}")
        out[f"c_{j}{i}"] = F.pow((q[2] - q[0]) / 1.349, F.lit(2.0)) if i == j else F.lit(0.0)
    return groups.withColumns(out).drop(*[f"q_{n}" for n in NAMES])


def moments(rows: DataFrame) -> DataFrame:
    """Per group: means and covariances."""
    pairs = [F.covar_pop(NAMES[j], NAMES[i]).alias(f"c_{j}{i}") for i, j in combinations_with_replacement(range(len(NAMES)), 2)]
    return rows.groupBy("language", "origin").agg(*[F.avg(n).alias(f"m_{n}") for n in NAMES], *pairs)


def triangular(groups: DataFrame) -> DataFrame:
    """The covariance with the floors' variances added, as the product of a lower triangle with itself."""
    for i in range(len(NAMES)):
        for j in range(i, len(NAMES)):
            rest = reduce(lambda a, k: a - F.col(f"l_{j}{k}") * F.col(f"l_{i}{k}"), range(i), F.col(f"c_{j}{i}"))  # noqa: B023
            if i == j:
                # by arithmetic never under the floor; by rounding it might be
                value = F.sqrt(F.greatest(rest, F.lit(0.0)) + F.lit(FLOORS[NAMES[i]] ** 2))
            else:
                value = rest / F.col(f"l_{i}{i}")
            groups = groups.withColumn(f"l_{j}{i}", value)
    return groups.drop(*[f"c_{j}{i}" for i, j in combinations_with_replacement(range(len(NAMES)), 2)])


def distances(rows: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance to their group's estimate."""
    estimate = triangular(groups)
    joined = rows.join(F.broadcast(estimate) if small else estimate, ["language", "origin"])
    for i, name in enumerate(NAMES):
        left = reduce(lambda a, k: a - F.col(f"l_{i}{k}") * F.col(f"z_{k}"), range(i), F.col(name) - F.col(f"m_{name}"))  # noqa: B023
        joined = joined.withColumn(f"z_{i}", left / F.col(f"l_{i}{i}"))
    d2 = reduce(lambda a, b: a + b, [F.col(f"z_{i}") * F.col(f"z_{i}") for i in range(len(NAMES))])
    return joined.select(*rows.columns, d2.alias("d2"))


def distance_bin() -> Column:
    return F.floor(F.log2(F.col("d2") + F.lit(1e-6)) * F.lit(BINS_PER_OCTAVE)).cast("int")


def quantile_bins(rows: DataFrame, part: float) -> DataFrame:
    """Per group: the distance bin up to which ``part`` of its rows lie, from counts per bin."""
    counts = rows.groupBy("language", "origin", distance_bin().alias("bin")).agg(F.count("*").alias("n"))
    group = Window.partitionBy("language", "origin")
    cumulated = counts.withColumns(
        {"upto": F.sum("n").over(group.orderBy("bin")), "total": F.sum("n").over(group)}
    )
    return cumulated.filter(F.col("upto") >= F.lit(part) * F.col("total")).groupBy("language", "origin").agg(F.min("bin").alias("edge"))


def estimates(own: DataFrame, sizes: DataFrame) -> tuple[DataFrame, bool]:
    """language, origin and the estimate ``e`` of the groups of ``own`` in ``sizes``, and whether they are few."""
    small = sizes.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    hint = F.broadcast if small else (lambda x: x)
    groups = checkpointed(sizes.drop("size"))
    for _ in range(STEPS):
        found = distances(own, groups, small)
        near = found.join(hint(quantile_bins(found, SUPPORT)), ["language", "origin"]).filter(distance_bin() <= F.col("edge"))
        groups = checkpointed(moments(near))
    middle = quantile_bins(distances(own, groups, small), 0.5)
    scale = middle.withColumn("scale", F.lit(MEDIAN_CHI2) / F.pow(F.lit(2.0), (F.col("edge") + 1) / F.lit(BINS_PER_OCTAVE))).drop("edge")
    # floors keep the estimate from shrinking to a point; distances are scaled down to it, never up
    scale = scale.withColumn("scale", F.least(F.col("scale"), F.lit(1.0)))
    found = triangular(groups.join(scale, ["language", "origin"]))
    e = F.struct(*[c for c in found.columns if c not in ("language", "origin")])
    return checkpointed(found.select("language", "origin", e.alias("e"))), small


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance of every row.

    ``docs`` has doc_id, text, lang and source. ``distance`` is the squared distance, scaled so that half
    of a group is under ``MEDIAN_CHI2``. Defined cases: a null text has no words and fails the base rules;
    null languages and sources are groups of their own; rows of groups with fewer than ``MIN_GROUP`` rows
    that pass the base rules are judged by the estimate of all such rows of their language or, if these are
    as few, of all languages; if so few pass in all, none has a distance (null) and all are kept. Only rows
    that pass the base rules make the estimates. Repeated rows count as often as they occur; extra columns
    are ignored.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    rows = checkpointed(base_statistics(docs).withColumn("base_failed", failed).withColumns(transformed()))
    own = rows.filter(~F.col("base_failed")).select("language", "origin", *NAMES)
    sizes = checkpointed(start(own))
    judged = rows
    of_group, small = estimates(own, sizes.filter(F.col("size") >= MIN_GROUP))
    judged = judged.join(F.broadcast(of_group) if small else of_group, ["language", "origin"], "left")
    # pools are made only of the languages that have a small group, and of all rows if such a language is small
    pooled = sizes.groupBy("language").agg(F.sum("size").alias("n"), F.min("size").alias("least")).filter(F.col("least") < MIN_GROUP)
    large, least = pooled.filter(F.col("n") >= MIN_GROUP).select("language"), pooled.agg(F.min("n")).first()[0]
    pools = []
    if least is not None:
        few = large.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
        members = own.join(F.broadcast(large) if few else large, "language", "left_semi").withColumn("origin", F.lit(ANY))
        of_language, few = estimates(members, start(members))
        of_language = of_language.select("language", F.col("e").alias("e_language"))
        judged = judged.join(F.broadcast(of_language) if few else of_language, "language", "left")
        pools.append("e_language")
    if least is not None and least < MIN_GROUP:
        members = own.withColumns({"language": F.lit(ANY), "origin": F.lit(ANY)})
        of_all, _ = estimates(members, start(members).filter(F.col("size") >= MIN_GROUP))
        judged = judged.join(F.broadcast(of_all.select(F.col("e").alias("e_all"))), F.lit(True), "left")
        pools.append("e_all")
    judged = judged.withColumn("e", F.coalesce("e", *pools)).drop(*pools)
    z = []
    for i, name in enumerate(NAMES):
        left = reduce(lambda a, k: a - F.col(f"e.l_{i}{k}") * F.col(f"z_{k}"), range(i), F.col(name) - F.col(f"e.m_{name}"))  # noqa: B023
        judged = judged.withColumn(f"z_{i}", left / F.col(f"e.l_{i}{i}"))
        z.append(F.col(f"z_{i}") * F.col(f"z_{i}"))
    distance = F.when(~F.col("base_failed"), reduce(lambda a, b: a + b, z) * F.col("e.scale"))
    kept = ~F.col("base_failed") & (F.coalesce(distance, F.lit(0.0)) <= CUTOFF)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), distance.alias("distance")
    )
