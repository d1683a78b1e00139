"""Conversation structure repair: the cheapest edits that make a conversation well formed, by checkpointed DP.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``. What has been read so far matters
only as one of four states, so the cheapest way from a row to the end is a vector of four costs, computed
backwards. Only every sqrt(n)-th vector of n rows is stored; walking forward, the vectors of one block at a
time are computed again, and at each row the ASCII-least edit is taken that the vectors show to be cheapest.
A letter and a state fix the state that follows, so this gives the least of all cheapest edit strings.

Conversations are cut into segments of ``SEGMENT`` rows, so none is held whole. The vector at a segment's end
comes from four-by-four matrices of the segments after it (costs from each state to each), which are multiplied
into the vector one after the other; the state at its start from the states that the segments before lead to.
Both run as streams over a few numbers for each segment. Texts take no part: a row is a letter for its
initial and fault, and the texts of rows that stay are joined to their edits at the end, once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from math import inf, isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.sequences import batched, numbered, records, streamed
from ledgermill.llm.text import WHITE

SEGMENT = 65_536
"""Rows of a conversation that one call works on."""

KEEP, DELETE, INSERT, REROLE, CUT_OFF = 0, 4, 3, 3, 3
"""Costs of the edits; ``CUT_OFF`` is added for a truncated row that stays."""

INITIALS = "sua"
START, SYSTEM, USER, ASSISTANT = range(4)
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
TURN = {state: next(to for initial, to in after.items() if initial in "ua") for state, after in AFTER.items()}
"""The state after a user or assistant row that is put in or gets its role."""

ENDS = (0, inf, inf, 0)
"""Cost of stopping in each state."""

NONE, BLANK, DUPLICATE, TRUNCATED = range(4)

Vector = tuple[float, float, float, float]


def letter(initial: Column, fault: Column) -> Column:
    """One letter, A to P, for a row's initial (s, u, a or any other) and fault."""
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return F.char(F.lit(65) + 4 * place + fault)


@cache
def meaning(symbol: str) -> tuple[str, int]:
    place, fault = divmod(ord(symbol) - 65, 4)
    return (INITIALS + "?")[place], fault


def with_inserts(costs: list[float]) -> Vector:
    """The same costs where rows may be put in first."""
    costs[USER] = min(costs[USER], INSERT + costs[ASSISTANT])
    costs[ASSISTANT] = min(costs[ASSISTANT], INSERT + costs[USER])
    for state in (START, SYSTEM):
        costs[state] = min(costs[state], INSERT + costs[TURN[state]])
    return tuple(costs)


def edits(symbol: str, state: int) -> Iterator[tuple[str, float, int]]:
    """Letter, cost and next state of every edit that takes a row, in ASCII order."""
    initial, fault = meaning(symbol)
    yield "D", DELETE, state
    if fault not in (BLANK, DUPLICATE):
        more = CUT_OFF if fault == TRUNCATED else 0
        if initial in AFTER[state]:
            yield "K", KEEP + more, AFTER[state][initial]
        yield "R", REROLE + more, TURN[state]


@cache
def _before(symbol: str, after: Vector) -> Vector:
    return with_inserts([min(cost + after[to] for _, cost, to in edits(symbol, s)) for s in range(4)])


def before(symbol: str, after: Vector) -> Vector:
    """The costs in front of a row from those behind it; differences between states take few values."""
    least = min(after)
    return tuple(c + least for c in _before(symbol, tuple(c - least for c in after)))


def checkpoints(symbols: str, after: Vector, block: int) -> list[Vector]:
    """The costs in front of every ``block``-th row, from the first on, and behind the last row."""
    stored = [after]
    for i in range(len(symbols) - 1, -1, -1):
        after = before(symbols[i], after)
        if i % block == 0:
            stored.append(after)
    return stored[::-1]


def walk(symbols: str, after: Vector, state: int, ends: bool) -> tuple[list[str], int]:
    """The edits of each row and the state behind them; ``ends``: rows may be put in behind the last one.

    An edit is a letter: D deletes, K keeps, U or A keeps as user or assistant, u or a puts one in first.
    """
    block = isqrt(len(symbols)) + 1
    stored = checkpoints(symbols, after, block)
    out = []
    for at in range(0, len(symbols), block):
        part = symbols[at : at + block]
        vectors = [stored[at // block + 1]]
        for symbol in reversed(part):
            vectors.append(before(symbol, vectors[-1]))
        vectors.reverse()
        for symbol, here, behind in zip(part, vectors, vectors[1:]):
            done = ""
            while True:
                ways = [(name, cost + behind[to], to) for name, cost, to in edits(symbol, state)]
                ways.append(("I", INSERT + here[TURN[state]], TURN[state]))
                name, _, state_after = min(w for w in ways if w[1] == here[state])
                role = "ua"[state_after == ASSISTANT]
                state = state_after
                done += {"I": role, "R": role.upper()}.get(name, name)
                if name != "I":
                    break
            out.append(done)
    if ends and out:
        while ENDS[state]:
            state = TURN[state]
            out[-1] += "ua"[state == ASSISTANT]
    return out, state


STOP = with_inserts(list(ENDS))
"""The costs behind the last row of a conversation."""


def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, segment, costs: the costs from each state in front of a segment to each behind it, end by end."""

    def rows() -> Iterator[tuple]:
        for key, segment, symbols in records(batches, "key", "segment", "symbols"):
            costs = []
            for end in range(4):
                vector = tuple(0 if s == end else inf for s in range(4))
                costs += checkpoints(symbols, vector, len(symbols))[0]
            yield key, segment, costs

    return batched(rows(), pa.schema([("key", pa.string()), ("segment", pa.int64()), ("costs", pa.list_(pa.float64()))]))


def vectors_behind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, segment, after: the costs behind each segment but the last, from matrices, last segment first."""

    def rows() -> Iterator[tuple]:
        last, vector = None, STOP
        for key, segment, costs in records(batches, "key", "segment", "costs"):
            vector = vector if key == last else STOP
            vector = tuple(min(costs[4 * end + s] + vector[end] for end in range(4)) for s in range(4))
            last = key
            yield key, segment - 1, list(vector)

    return batched(rows(), pa.schema([("key", pa.string()), ("segment", pa.int64()), ("after", pa.list_(pa.float64()))]))


def leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, segment, to, last: the state behind a segment for each in front of it, and its last row's letter."""

    def rows() -> Iterator[tuple]:
        for key, segment, symbols, after in records(batches, "key", "segment", "symbols", "after"):
            yield key, segment, [walk(symbols, tuple(after), s, False)[1] for s in range(4)], symbols[-1]

    fields = [("key", pa.string()), ("segment", pa.int64()), ("to", pa.list_(pa.int32())), ("last", pa.string())]
    return batched(rows(), pa.schema(fields))


def states_in_front(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, segment, state, previous: what each segment but the first starts from, first segment first."""

    def rows() -> Iterator[tuple]:
        known, state = None, START
        for key, segment, to, last in records(batches, "key", "segment", "to", "last"):
            state = to[state if key == known else START]
            known = key
            yield key, segment + 1, state, last

    fields = [("key", pa.string()), ("segment", pa.int64()), ("state", pa.int32()), ("previous", pa.string())]
    return batched(rows(), pa.schema(fields))


def walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, segment, edits (of each row, with spaces between), counts of faults and breaks, and the cost."""

    def rows() -> Iterator[tuple]:
        for key, segment, symbols, after, state, previous in records(batches, "key", "segment", "symbols", "after", "state", "previous"):
            ends = after is None
            done, _ = walk(symbols, STOP if ends else tuple(after), state or START, ends)
            found = [meaning(s) for s in (previous or "") + symbols]
            pairs = zip(found, found[1:])
            illegal = sum(x + y not in ("su", "ua", "au") for (x, _), (y, _) in pairs)
            faults = [fault for _, fault in found[len(previous or "") :]]
            cost = 0
            for fault, row in zip(faults, done):
                own = next(c for c in row if c in "DKUA")
                cost += INSERT * (len(row) - 1) + {"D": DELETE, "K": KEEP}.get(own, REROLE)
                cost += CUT_OFF * (fault == TRUNCATED and own != "D")
            yield key, segment, " ".join(done), *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, cost

    counts = [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    return batched(rows(), pa.schema([("key", pa.string()), ("segment", pa.int64()), ("edits", pa.string()), *counts]))


def keyed(conversations: DataFrame) -> DataFrame:
    """conv_id, key (its text, never null), turn, role, text of each row; a null role or text is one space."""
    name = F.col("conv_id").cast("string")
    return conversations.select(
        "conv_id",
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("key"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with a twentieth of the rows each dropped, emptied, unpunctuated, doubled and made user's.

    Which, depends on the crc32 of ``conv_id:turn``, in which a null is one space.
    """
    rows = keyed(conversations)
    name = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = rows.withColumn("damage", F.crc32(F.concat(name[0], F.lit(":"), name[1])) % 20)
    kind = F.col("damage")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.filter("damage <> 0").select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    ).drop("copy")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edits with the repaired rows, and a summary of each conversation, of rows (conv_id, turn, role, text).

    Edits: key, row (the source row's place in its conversation, from 0), step (edits in front of it and its own),
    edit (I, D, K or R) and, unless deleted, role and text. Summary: key, gaps, blank, duplicate, truncated,
    illegal, cost. ``key`` is "=" and the conv_id as text.

    Defined cases: rows are taken by turn, nulls first, rows of one turn by role and then the md5 of their text.
    A null conv_id is a conversation of its own, with an empty key. A null role or text is one space; an empty
    role has no initial and cannot be kept. Extra columns are ignored.
    """
    rows = keyed(conversations).withColumn("mark", F.unhex(F.md5(F.col("text").cast("binary"))))
    end = F.rtrim("text", F.lit(WHITE.decode()))
    faults = F.when(F.length(end) == 0, BLANK).when(~F.right(end, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    light = rows.select("key", "turn", "role", "mark", faults.alias("fault"))
    light = numbered(light, "key", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")])

    first = light.groupBy("key", "role", "mark").agg(F.min("index").alias("index"))
    first = first.select("key", "index", F.lit(True).alias("first"))
    fault = F.when((F.col("fault") != BLANK) & F.col("first").isNull(), DUPLICATE).otherwise(F.col("fault"))
    symbol = letter(F.substring("role", 1, 1), fault)
    by_segment = F.floor(F.col("index") / SEGMENT)
    letters = light.join(first, ["key", "index"], "left").select("key", "index", symbol.alias("symbol"))
    letters = letters.groupBy("key", by_segment.alias("segment")).agg(F.array_sort(F.collect_list(F.struct("index", "symbol"))).alias("rows"))
    segments = letters.select("key", "segment", F.array_join("rows.symbol", "").alias("symbols"))

    after = segments.filter("segment > 0").mapInArrow(matrices, "key string, segment long, costs array<double>")
    after = streamed(after, "key", [F.col("segment").desc()]).mapInArrow(vectors_behind, "key string, segment long, after array<double>")
    segments = segments.join(after, ["key", "segment"], "left")
    front = segments.filter("after is not null").mapInArrow(leads, "key string, segment long, to array<int>, last string")
    front = streamed(front, "key", [F.col("segment")]).mapInArrow(states_in_front, "key string, segment long, state int, previous string")
    counts = ("blank", "duplicate", "truncated", "illegal", "cost")
    schema = "key string, segment long, edits string, " + ", ".join(f"{c} long" for c in counts)
    walked = segments.join(front, ["key", "segment"], "left").mapInArrow(walks, schema)

    turns = light.groupBy("key", "turn").agg(F.lit(1)).groupBy("key")
    turns = turns.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    summary = turns.join(walked.groupBy("key").agg(*(F.sum(c).alias(c) for c in counts)), "key")

    steps = walked.select("key", "segment", F.posexplode(F.split("edits", " ")).alias("at", "row_edits"))
    steps = steps.select("key", (F.col("segment") * SEGMENT + F.col("at")).alias("index"), "row_edits")
    content = light.select("key", "index", "turn", "role", "mark")
    steps = steps.join(content, ["key", "index"])
    steps = steps.select("key", "index", "turn", "role", "mark", F.posexplode(F.split("row_edits", "")).alias("step", "how"))
    stays = F.col("how").isin("K", "U", "A")
    texts = rows.groupBy("key", F.struct("turn", "role", "mark").alias("content")).agg(F.first("text").alias("own_text"))
    kept = steps.filter(stays).withColumn("content", F.struct("turn", "role", "mark")).join(texts, ["key", "content"]).drop("content")
    done = kept.unionByName(steps.filter(~stays).withColumn("own_text", F.lit(None).cast("string")))
    made = F.lower("how") == F.col("how")
    given = F.when(F.lower("how") == "u", "user").when(F.lower("how") == "a", "assistant")
    repaired = done.select(
        "key",
        F.col("index").alias("row"),
        "step",
        F.when(made, "I").when(F.col("how").isin("U", "A"), "R").otherwise(F.col("how")).alias("edit"),
        F.when(F.col("how") == "K", F.col("role")).otherwise(given).alias("role"),
        F.when(made, "").otherwise(F.col("own_text")).alias("text"),
    )
    return repaired, summary


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, audit, repaired_sha256 of edits in order; a conversation's text is hashed as it passes."""

    def rows() -> Iterator[tuple]:
        last, audit, hashed, any_row = None, [], hashlib.sha256(), False
        for key, edit, role, text in records(batches, "key", "edit", "role", "text"):
            if key != last and last is not None:
                yield last, "".join(audit), hashed.hexdigest()
            if key != last:
                last, audit, hashed, any_row = key, [], hashlib.sha256(), False
            audit.append(edit)
            if edit != "D":
                hashed.update((b"\n" if any_row else b"") + role + b":" + text)
                any_row = True
        if last is not None:
            yield last, "".join(audit), hashed.hexdigest()

    return batched(rows(), pa.schema([(c, pa.string()) for c in ("key", "audit", "repaired_sha256")]))


def repair_report(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each conv_id of ``conversations`` about the repair of ``rows``; without rows, zeros and no edits.

    SHA-256 runs from a text's first byte to its last, so the repaired rows of a conversation pass through one task
    here, as a stream.
    """
    repaired, summary = repair(rows)
    passing = repaired.select("key", "row", "step", "edit", *(F.col(c).cast("binary").alias(c) for c in ("role", "text")))
    hashed = streamed(passing, "key", [F.col("row"), F.col("step")]).mapInArrow(digests, "key string, audit string, repaired_sha256 string")
    every = keyed(conversations).select("conv_id", "key").distinct()
    found = every.join(summary, "key", "left").join(hashed, "key", "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
