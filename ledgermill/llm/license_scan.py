"""License scans: phrases found by Aho-Corasick, license expressions evaluated by a shunting-yard parser.

A text is lower-cased and split into words; its phrases are matched in one pass over the words joined by
single spaces, so that line breaks and punctuation within a notice do not matter. Behind an identifier tag
(``SPDX-License-Identifier:``) the text itself is read as an expression of ``and``, ``or`` and ``with``.

Every license has a weight from 0 (no condition) to 1 (all rights reserved). ``or`` leaves the reader the
lighter side, ``and`` binds to the heavier, and an exception (``with``) halves what it is attached to. The
score of a text is its heaviest notice.
"""

from __future__ import annotations

import re
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.jobs import by_batch, utf8

#: The phrases every scan looks for and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Further notices, and the licenses they name.
NOTICES = {
    "academic free license": "afl-3.0",
    "affero general public license": "agpl",
    "apache license": "apache-2.0",
    "artistic license": "artistic-2.0",
    "boost software license": "bsl-1.0",
    "bsd license": "bsd",
    "business source license": "busl-1.1",
    "common development and distribution license": "cddl-1.0",
    "creative commons attribution": "cc-by",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution noderivatives": "cc-by-nd",
    "creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0-1.0",
    "eclipse public license": "epl-2.0",
    "european union public licence": "eupl-1.2",
    "free documentation license": "gfdl",
    "isc license": "isc",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "microsoft public license": "ms-pl",
    "mit license": "mit",
    "mozilla public license": "mpl-2.0",
    "no rights reserved": "cc0-1.0",
    "open data commons attribution license": "odc-by-1.0",
    "open database license": "odbl-1.0",
    "open software license": "osl-3.0",
    "permission is hereby granted free of charge": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "proprietary and confidential": "proprietary",
    "python software foundation license": "psf-2.0",
    "redistribution and use in source and binary forms": "bsd",
    "released into the public domain": "public-domain",
    "server side public license": "sspl-1.0",
    "sil open font license": "ofl-1.1",
    "the unlicense": "unlicense",
    "this is free and unencumbered software": "unlicense",
    "zlib license": "zlib",
}

#: How much a license asks of the reader, from nothing to everything.
WEIGHTS = {
    "public-domain": 0.05, "cc0-1.0": 0.05, "unlicense": 0.05, "0bsd": 0.05, "wtfpl": 0.05, "mit-0": 0.05,
    "mit": 0.2, "isc": 0.2, "zlib": 0.2, "bsl-1.0": 0.2, "x11": 0.2, "psf-2.0": 0.2, "python-2.0": 0.2,
    "bsd": 0.2, "bsd-2-clause": 0.2, "bsd-3-clause": 0.2, "bsd-4-clause": 0.25, "apache-1.1": 0.25, "apache-2.0": 0.25, "afl-3.0": 0.25,
    "cc-by": 0.3, "cc-by-3.0": 0.3, "cc-by-4.0": 0.3, "odc-by-1.0": 0.3, "ms-pl": 0.3, "ofl-1.1": 0.35, "artistic-1.0": 0.4, "artistic-2.0": 0.4,
    "mpl-1.1": 0.5, "mpl-2.0": 0.5, "epl-1.0": 0.5, "epl-2.0": 0.5, "cddl-1.0": 0.5, "cddl-1.1": 0.5, "odbl-1.0": 0.5,
    "cc-by-sa": 0.5, "cc-by-sa-3.0": 0.5, "cc-by-sa-4.0": 0.5, "lgpl": 0.6, "lgpl-2.0": 0.6, "lgpl-2.1": 0.6, "lgpl-3.0": 0.6, "eupl-1.2": 0.6,
    "cc-by-nd": 0.65, "cc-by-nd-4.0": 0.65, "osl-3.0": 0.7, "gfdl": 0.7, "gfdl-1.3": 0.7, "gpl": 0.75, "gpl-1.0": 0.75, "gpl-2.0": 0.75, "gpl-3.0": 0.75,
    "cc-by-nc": 0.8, "cc-by-nc-4.0": 0.8, "cc-by-nc-sa": 0.85, "cc-by-nc-sa-4.0": 0.85, "cc-by-nc-nd-4.0": 0.85,
    "agpl": 0.85, "agpl-1.0": 0.85, "agpl-3.0": 0.85, "sspl-1.0": 0.9, "busl-1.1": 0.9, "proprietary": 1.0, "reserved": 1.0,
}
UNKNOWN = 0.9
"""An identifier behind a tag that is in no list."""

TAG = re.compile(rb"spdx-license-identifier[ \t]*:[ \t]*")
PART = re.compile(rb"[ \t]*([()]|[a-z0-9][a-z0-9.+-]*)")
BINDS = {"or": 1, "and": 2, "with": 3}


def identifiers(line: bytes) -> list[str]:
    """The parts of a lower-cased expression, up to the first byte that cannot be in one."""
    parts, at = [], 0
    while m := PART.match(line, at):
        parts.append(m[1].decode())
        at = m.end()
    return parts


def postfix(parts: list[str]) -> list[str]:
    """Operands and operators in the order in which to apply them: the longest valid start of ``parts``.

    The expression ends where an operand or operator stands that cannot follow; open brackets are closed.
    """
    out, waiting, operand_next = [], [], True
    for part in parts:
        if part == "(":
            if not operand_next:
                break
            waiting.append(part)
        elif part == ")":
            if operand_next or "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif part in BINDS:
            if operand_next:
                break
            while waiting and waiting[-1] != "(" and BINDS[waiting[-1]] >= BINDS[part]:
                out.append(waiting.pop())
            waiting.append(part)
            operand_next = True
        else:
            if not operand_next:
                break
            out.append(part)
            operand_next = False
    rest = [x for x in reversed(waiting) if x != "("]
    return out + (rest[1:] if operand_next else rest)  # an operator that waits for its right side goes


def license_of(identifier: str) -> str:
    """The identifier without what says "or later" and "only"."""
    for end in ("-or-later", "-only", "+"):
        identifier = identifier.removesuffix(end)
    return identifier


def evaluate(steps: list[str]) -> tuple[float, set[str]]:
    """Weight and licenses of a postfix expression; one without operands weighs nothing."""
    stack: list[tuple[float, set[str]]] = []
    for step in steps:
        if step in BINDS:
            (b, right), (a, left) = stack.pop(), stack.pop()
            if step == "with":
                stack.append((a / 2, left))
            else:
                stack.append((min(a, b) if step == "or" else max(a, b), left | right))
        else:
            name = license_of(step)
            stack.append((WEIGHTS.get(name, UNKNOWN), {name}))
    return stack[-1] if stack else (0.0, set())


def expression(line: bytes) -> tuple[float, set[str]]:
    return evaluate(postfix(identifiers(line)))


@cache
def tables() -> tuple[ahocorasick.Automaton, bytes]:
    """The automaton over phrases between spaces, and what turns every byte outside words into a space."""
    automaton = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE}.items():
        automaton.add_word(f" {phrase} ", (len(phrase) + 2, label, phrase in BASE))
    automaton.make_automaton()
    word = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
    return automaton, bytes(b if b in word else 32 for b in range(256))


def scan(raw: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels and score of one text."""
    automaton, to_words = tables()
    lower = raw.lower()
    words = lower.translate(to_words).split()
    line = (b" " + b" ".join(words) + b" ").decode("latin-1")
    n_base, first, last, base, labels, score, at, word = 0, None, None, set(), set(), 0.0, 0, 0
    hits = sorted((end - length + 1, label, is_base) for end, (length, label, is_base) in automaton.iter(line))
    for start, label, is_base in hits:
        word += line.count(" ", at, start)
        at = start
        labels.add(label)
        score = max(score, WEIGHTS[label])
        if is_base:
            n_base += 1
            first = word if first is None else first
            last = word
            base.add(label)
    if b"spdx-license-identifier" in lower:
        tags = list(TAG.finditer(lower))
        for m, after in zip(tags, [*(t.start() for t in tags[1:]), len(lower)]):
            # an expression ends with its line, and where the next tag stands: no byte is read twice
            line_end = lower.find(b"\n", m.end(), after)
            weight, names = expression(lower[m.end() : after if line_end < 0 else line_end])
            labels |= names
            score = max(score, weight)
    return len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row (doc_id, text).

    Defined cases: a null or empty text has no words, no places, empty labels and score 0. Places that
    overlap all count. Repeated rows give repeated results, a null id stays null, extra columns are ignored.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = list(zip(*map(scan, batch["text"].to_pylist()))) or [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
        names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *map(pa.array, found, kinds)], ["doc_id", *names])

    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return by_batch(docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text")), work, schema)
