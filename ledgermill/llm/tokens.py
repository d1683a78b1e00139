"""Token ids of whole texts, and packing them into the fewest bits."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ledgermill.llm.jobs import HOLDERS

CACHE_PIECES = 300_000

PIECE = re.compile(r"[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+")
"""A run of ASCII white space with what follows it. No token of a byte-level or word BPE spans two."""

UNSAFE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]|<\|")
"""White space outside ASCII, and the start of special tokens: such texts are encoded in one call."""


SIMPLE = re.compile(r"([ \n]?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?*$%&#|]*)")
"""Pieces of letters that no normal form changes, and signs: how they are cut needs no general rules."""

PROBES = ("a", " the", "\nThe", " Straße,", "Été..", " ÀB!!", "\nñandú;$", " x###", "Zwölf|", " de%%%", " ndednd$$$", "éaux:", "\nØre?")


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + others.index(b)) for b in range(256)}


BYTES = byte_letters()


CONTROLS = ("<|", "\x1c", "\x1d", "\x1e", "\x1f")
"""What of ``UNSAFE`` an ASCII text can hold."""

MIXED = ("\0", "\t", "\x0b", "\x0c", "\r", "  ", " \n", "\n ", "\n\n")
"""A text without these has one space or line end between its words, if any."""


def is_unsafe(text: str) -> bool:
    if text.isascii():
        return any(map(text.__contains__, CONTROLS))
    return UNSAFE.search(text) is not None


def pieces_of(text: str) -> list[str]:
    """The matches of ``PIECE``; of a text that begins with white space, an empty one before them."""
    if any(map(text.__contains__, MIXED)):
        return PIECE.findall(text)
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


CHUNK_CHARS = 1 << 20
"""Plain texts are encoded together, about so many characters at once."""

OTHER = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xff\u2010-\u2027\u2030-\u205e\u20ac\u2122]|<\|")
"""What a plain text does not have. ASCII, Latin-1 and common signs are in no normal form anything else, and each has
one small letter; white space is ASCII's alone."""

FOLDING = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
}
BYTE_LEVEL = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}}
"""How a tokenizer makes words if ``words_of`` is to give the same: small letters cut by this expression, or the text as it
is cut by the library's own, in which a space belongs to the word behind it."""

SPACE, LETTER, NUMBER, SIGN, END = range(5)

KINDS = np.full(256, SIGN, np.uint8)
"""Of each ASCII byte."""
KINDS[list(b" \t\n\x0b\x0c\r")] = SPACE
KINDS[ord("A") : ord("Z") + 1] = KINDS[ord("a") : ord("z") + 1] = LETTER
KINDS[ord("0") : ord("9") + 1] = NUMBER
BETWEEN = b"\xff"
"""What no UTF-8 has, between texts."""
KINDS[BETWEEN[0]] = END

LATIN = np.array([LETTER if chr(c).isalpha() else NUMBER if chr(c).isnumeric() else SIGN for c in range(128, 256)], np.uint8)


def is_plain(text: str) -> bool:
    if text.isascii():
        return not any(map(text.__contains__, CONTROLS))
    return OTHER.search(text) is None


def words_of(data: bytes, folding: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where each run begins in UTF-8 of plain texts, and which runs are words, as ``FOLDING`` or ``BYTE_LEVEL`` cuts them.

    A run is of letters, of numbers, of signs or of white space; a contraction is one by itself. If ``folding``, each
    number is one too, and white space is no word. Else the last of the white space in front of a run is apart from
    the rest, and of one run with what follows if it is a space.
    """
    raw = np.frombuffer(data, np.uint8)
    kind = KINDS[raw]
    two = np.flatnonzero((raw >= 0xC2) & (raw < 0xE0))  # U+0080 to U+00FF; signs have three bytes
    kind[two] = kind[two + 1] = LATIN[(raw[two] - 0xC2) * np.uint8(64) + (raw[two + 1] - 0x80)]
    begins = np.ones(len(raw), bool)
    begins[1:] = kind[1:] != kind[:-1]
    if folding:
        begins[1:] |= (kind[1:] == NUMBER) & (raw[1:] & 0xC0 != 0x80)
    else:
        front = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & (kind[1:] != END))
        begins[front] = True
        begins[front[raw[front] == ord(" ")] + 1] = False
    short = np.flatnonzero((raw == ord("'")) & begins)
    after, last = (np.concatenate([raw, np.zeros(2, np.uint8)])[short + k] for k in (1, 2))
    one = np.isin(after, list(b"stmd"))
    both = (((after == ord("r")) | (after == ord("v"))) & (last == ord("e"))) | ((after == ord("l")) & (last == ord("l")))
    begins[short[one | both] + 1] = False
    ends = np.concatenate([short[one] + 2, short[both] + 3])
    begins[ends[ends < len(raw)]] = True
    at = np.flatnonzero(begins)
    return at, (kind[at] != END) & ((kind[at] != SPACE) | (not folding))


class Known(dict):
    """Ids of strings as bytes, encoded when first asked for; emptied when full, so memory is bounded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, text: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            self.clear()
        ids = self[text] = self.encode(text)
        return ids


class Encoder:
    """A tokenizer of the ``tokenizers`` library, with the ids of pieces remembered between white space.

    The ids equal those of one call over the whole text; texts for which that is not certain get one, and so
    do texts that may hold a special token, which has an id of its own as in that call. For
    words of plain letters the tokenizer's model is asked directly, without its normalizer and splitter;
    that is done only if it gives the same ids on ``PROBES``. ``each`` encodes many texts; plain ones together, if
    the tokenizer is a ``FOLDING`` or ``BYTE_LEVEL`` one: the model is asked once for each of their different words.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.line = self.whole("\n")
        self.words = Known(self.word)
        self.pieces = Known(self.whole)
        for self.lower in (False, True):
            self.words.clear()
            if all(self.piece(p) == self.whole(p) for p in PROBES):
                self.pieces = Known(self.piece)
                break
        made = json.loads(self.tokenizer.to_str())
        self.folding, level = (all(made[k] == v for k, v in kind.items()) for kind in (FOLDING, BYTE_LEVEL))
        self.joint = Known(self.joint_word)
        self.joins = (self.folding or level) and [x.tobytes() for x in self.together(PROBES)] == list(map(self.whole, PROBES))

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def word(self, text: str) -> bytes:
        """Ids of a run of letters or of signs, or of letters after a space."""
        coded = text.replace(" ", "Ġ") if text.isascii() else text.encode().decode("latin-1").translate(BYTES)
        return array("I", [t.id for t in self.tokenize(coded)]).tobytes()

    def piece(self, piece: str) -> bytes:
        """Ids of a piece. In a vocabulary of lower case (``lower``) white space has none; else it is a letter too."""
        m = SIMPLE.fullmatch(piece)
        if m is None:
            return self.whole(piece)
        white, letters, signs = m.groups()
        words = self.words
        if self.lower:
            ids = words[letters.lower()]
        elif white == "\n":
            ids = self.line + words[letters]
        else:
            ids = words[white + letters]
        return ids + words[signs] if signs else ids

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if is_unsafe(text):
            return np.frombuffer(self.whole(text), np.uint32)
        return np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces_of(text))), np.uint32)

    def joint_word(self, word: bytes) -> bytes:
        return array("I", [t.id for t in self.tokenize(word.decode("latin-1").translate(BYTES))]).tobytes()

    def together(self, texts: Iterable[str]) -> list[np.ndarray]:
        """Ids of each of some plain texts."""
        parts = [(t.lower() if self.folding else t).encode() for t in texts]
        data = BETWEEN.join(parts)
        at, use = words_of(data, self.folding)
        runs = [None, pa.py_buffer(np.append(at, len(data)).astype(np.int32)), pa.py_buffer(data)]
        found = pa.Array.from_buffers(pa.binary(), len(at), runs).filter(pa.array(use)).dictionary_encode()
        ids = [self.joint[w] for w in found.dictionary.to_pylist()]
        number = found.indices.to_numpy()
        size = np.array([len(x) // 4 for x in ids], np.int64)
        first, own = (np.cumsum(size) - size)[number], size[number]
        ends = np.concatenate([[0], np.cumsum(own)])
        every = np.frombuffer(b"".join(ids), np.uint32)[np.repeat(first - ends[:-1], own) + np.arange(ends[-1])]
        begin = np.cumsum([0] + [len(p) + 1 for p in parts])  # of each text; what is behind the last
        cuts = ends[np.searchsorted(at[use], begin)]
        return [every[a:b] for a, b in zip(cuts, cuts[1:])]

    def each(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of the texts in turn."""
        held, size = [], 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= CHUNK_CHARS:
                yield from self.chunk(held)
                held, size = [], 0
        yield from self.chunk(held)

    def chunk(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [self.joins and len(t) <= CHUNK_CHARS and is_plain(t) for t in texts]
        made = iter(self.together([t for t, p in zip(texts, plain) if p]) if any(plain) else ())
        return (next(made) if p else self(t) for t, p in zip(texts, plain))


ENCODERS: dict[str, Encoder] = {}
"""Those of this process, by the tokenizer's path."""


def encoder(path: str) -> Encoder:
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def forget_encoders() -> None:
    """Give back the memory of this process's encoders; one that is still in use asks its tokenizer again."""
    for used in ENCODERS.values():
        for known in (used.words, used.pieces, used.joint):
            known.clear()
    ENCODERS.clear()


HOLDERS.append(forget_encoders)


@cache
def vocabulary(path: str) -> int:
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def bits_for(n: int) -> int:
    """Bits that hold every id under ``n``."""
    return max(1, (n - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` bits of each id, lowest first, without gaps."""
    if bits == 16:
        return ids.astype("<u2").tobytes()
    planes = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & np.uint32(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int, start: int = 0) -> np.ndarray:
    """``count`` ids from number ``start`` on."""
    if bits == 16:
        return np.frombuffer(data, "<u2", count, 2 * start).astype(np.uint32)
    first, last = start * bits // 8, -(-(start + count) * bits // 8)
    raw = np.unpackbits(np.frombuffer(data, np.uint8)[first:last], bitorder="little")
    skip = start * bits - 8 * first
    planes = raw[skip : skip + count * bits].reshape(count, bits)
    return planes.astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))
