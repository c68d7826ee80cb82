"""What operators 1 and 9 share: a SentencePiece model file and its words.

The model file is a protocol buffer.  Its fields are read with a small wire
reader: pieces (text, score, type), the model type, byte fallback, and the
normaliser's flags.  Only the identity normaliser (no character map) is
supported; others are refused.

If no piece has the space mark after another character, no piece crosses the
border before a space mark, so a text is the concatenation of its words (with
the marks before them) and words are solved once and kept in a bounded cache.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

SPACE = "▁"
#: Fixed values of the file format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: What an unknown character costs beyond the worst piece.
UNKNOWN_PENALTY = 10.0
#: Words in a worker's cache; longer words are not kept.
CACHE, LONG = 300_000, 64

_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


def _fields(buf: bytes):
    at = 0

    def varint() -> int:
        nonlocal at
        v = shift = 0
        while True:
            b = buf[at]
            at += 1
            v |= (b & 127) << shift
            shift += 7
            if b < 128:
                return v

    while at < len(buf):
        key = varint()
        num, wire = key >> 3, key & 7
        if wire == 0:
            yield num, varint()
        elif wire == 2:
            n = varint()
            yield num, buf[at:at + n]
            at += n
        else:
            n = 4 if wire == 5 else 8
            yield num, buf[at:at + n]
            at += n


class Vocabulary:
    """Pieces, scores and flags of a model file (its bytes)."""

    def __init__(self, proto: bytes):
        self.text: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        self.model, self.byte_fallback = UNIGRAM, False
        self.dummy_prefix = self.trim = self.escape = True
        for num, v in _fields(proto):
            if num == 1:
                f = dict(_fields(v))
                self.text.append(f.get(1, b"").decode())
                self.score.append(struct.unpack("<f", f[2])[0] if 2 in f else 0.0)
                self.kind.append(f.get(3, NORMAL))
            elif num == 2:
                f = dict(_fields(v))
                self.model = f.get(3, UNIGRAM)
                self.byte_fallback = bool(f.get(35, 0))
            elif num == 3:
                f = dict(_fields(v))
                if f.get(2):
                    raise ValueError("only the identity normaliser is supported")
                self.dummy_prefix, self.trim, self.escape = (bool(f.get(k, 1)) for k in (3, 4, 5))
        if not self.escape or not self.byte_fallback:
            raise ValueError("a model with escaped spaces and byte fallback is needed")
        if any(SPACE in p.lstrip(SPACE) for p, k in zip(self.text, self.kind) if k == NORMAL):
            raise ValueError("a piece spans two words")
        self.ids = {p: i for i, (p, k) in enumerate(zip(self.text, self.kind)) if k in (NORMAL, USER)}
        self.unknown = self.kind.index(UNKNOWN)
        self.byte_id = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(self.text, self.kind))
                        if k == BYTE}
        self.worst = min(s for s, k in zip(self.score, self.kind) if k == NORMAL)

    def normalise(self, text: str) -> str:
        if self.trim:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return ""
        return ((" " if self.dummy_prefix else "") + text).replace(" ", SPACE)

    def words(self, text: str) -> list[str]:
        """Words without their (first) space mark."""
        if not self.trim and self.dummy_prefix and text and "  " not in text \
                and text[0] != " " and text[-1] != " " and SPACE not in text:
            return text.split(" ")
        norm = self.normalise(text)
        if norm and norm[0] != SPACE:
            raise ValueError("a model without the dummy prefix is not supported")
        return [w[1:] for w in _WORD.findall(norm)]


class Cached(dict):
    """word -> value, solved when missing; cleared when full."""

    def __init__(self, solve: Callable[[str], object]):
        super().__init__()
        self.solve = solve

    def __missing__(self, word: str):
        value = self.solve(SPACE + word)
        if len(word) <= LONG:
            if len(self) >= CACHE:
                self.clear()
            self[word] = value
        return value
