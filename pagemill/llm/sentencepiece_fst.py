"""Operator 1: SentencePiece encoding and decoding as a shortest path.

The transducer is the composition of the normaliser (identity on characters,
space -> mark, a mark in front), the pieces (arcs that read a piece's
characters and write its id) and the byte fallback (arcs that read a character
that is no piece and write its bytes).  It is composed with each input word
lazily, with an Aho-Corasick automaton to read the pieces: a state is a position
in the word, and for merge models also the last piece.  Weights form the
tropical semiring (sum along a path, minimum over paths), and positions are a
topological order, so one sweep relaxes all arcs.

* Unigram models: an arc weighs minus its piece's score.
* Merge (BPE) models are not additive, but a sequence of pieces is the merge
  result exactly when merging the text of any two neighbours gives back these
  two.  So an arc from piece x to piece y weighs 0 when (x, y) is stable and
  infinity otherwise, and the one finite path is the encoding.  Whether a pair is
  stable is read off the two pieces' own merge steps, run side by side.

Decoding reverses the arcs: piece texts and bytes are concatenated, marks
become spaces, and the mark in front goes.

Defined cases: null and empty texts have no pieces; a text of any length is
encoded whole, word by word, and a word of any length (a run of blanks) in
n log n steps where it is merged directly; repeated rows are encoded each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import zlib
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .pieces import BPE, SPACE, UNKNOWN_PENALTY, Cached, Vocabulary

STABLE_CACHE = 2_000_000
#: Marks of a position: no arc into it yet; its character is written as bytes.
NONE, BYTES = -2, -1
NEVER = float("-inf")


class Transducer:
    _made: dict[str, Transducer] = {}

    def __init__(self, proto: bytes):
        self.vocab = v = Vocabulary(proto)
        self.pieces = ahocorasick.Automaton()
        for piece, i in v.ids.items():
            self.pieces.add_word(piece, (len(piece), i))
        self.pieces.make_automaton()
        self.merges = v.model == BPE
        self.chars_known = all(c in v.ids for p in v.ids for c in p)
        self.unk_cost = -(v.worst - UNKNOWN_PENALTY)
        self.traces: dict[int, tuple | None] = {}
        self.stable: dict[tuple[int, int], bool] = {}
        self.out = [p.replace(SPACE, " ").encode() for p in v.text]
        for b, i in v.byte_id.items():
            self.out[i] = bytes([b])
        self.solved = Cached(lambda w: array("I", self.shortest(w)).tobytes())

    @classmethod
    def of(cls, path: str) -> Transducer:
        if path not in cls._made:
            cls._made[path] = cls(open(path, "rb").read())
        return cls._made[path]

    def merge_steps(self, text: str):
        """Plain merging, the best-scored pair first, the leftmost of equals:
        the score of each step, and the parts before and after the steps."""
        parts = list(text)
        ids, score = self.vocab.ids, self.vocab.score
        yield None, parts
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or score[i] > best):
                    best, at = score[i], k
            if at < 0:
                return
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            yield best, parts

    def merged(self, word: str) -> list[str]:
        """The parts after the last of :meth:`merge_steps`.  Pairs wait in a
        heap, by score and then from the left, and parts in a linked list, so a
        long run of marks costs n log n."""
        ids, score = self.vocab.ids, self.vocab.score
        n = len(word)
        part: list[str | None] = list(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def pair(k: int) -> tuple | None:
            i = ids.get(part[k] + part[after[k]])
            # the lengths tell whether the pair is still the same one
            return None if i is None else (-score[i], k, len(part[k]), len(part[after[k]]))

        heap = [p for p in map(pair, range(n - 1)) if p]
        heapq.heapify(heap)
        while heap:
            _, k, left, right = heapq.heappop(heap)
            m = after[k]
            if part[k] is None or len(part[k]) != left or m == n or len(part[m]) != right:
                continue
            part[k], part[m], after[k] = part[k] + part[m], None, after[m]
            if after[m] < n:
                before[after[m]] = k
                new = pair(k)
                if new:
                    heapq.heappush(heap, new)
            if before[k] >= 0:
                new = pair(before[k])
                if new:
                    heapq.heappush(heap, new)
        return [p for p in part if p is not None]

    def trace(self, i: int) -> tuple | None:
        """Scores of the steps that merge piece i from its characters, and its
        first and last part before each; None if merging ends elsewhere."""
        if i not in self.traces:
            scores, firsts, lasts, n = [], [], [], 0
            for score, parts in self.merge_steps(self.vocab.text[i]):
                if score is not None:
                    scores.append(score)
                firsts.append(parts[0])
                lasts.append(parts[-1])
                n = len(parts)
            self.traces[i] = None if n != 1 else ([*scores, NEVER], firsts, lasts)
        return self.traces[i]

    def fits(self, x: int, y: int) -> bool:
        """Whether merging the text of x and y side by side keeps the two: no
        merge over the border is ever the best (leftmost) one."""
        ids, score = self.vocab.ids, self.vocab.score
        xs, _, ends = self.trace(x)
        ys, starts, _ = self.trace(y)
        a = b = 0
        while True:
            over = ids.get(ends[a] + starts[b])
            if over is not None and score[over] > xs[a] and score[over] >= ys[b]:
                return False
            if xs[a] == ys[b] == NEVER:
                return True
            if xs[a] >= ys[b]:
                a += 1
            else:
                b += 1

    def merge_path(self, word: str) -> list[int]:
        """The path of weight 0.  A position is done with the first arc of
        weight 0 into it, as no path is lighter."""
        ids, stable = self.vocab.ids, self.stable
        last = [NONE, *(NONE if c in ids else BYTES for c in word)]
        for end, (size, i) in self.pieces.iter(word):
            j = end + 1
            if last[j] != NONE:
                continue
            before = last[j - size]
            if j != size and before == NONE:
                continue
            if before >= 0:
                fits = stable.get((before, i))
                if fits is None:
                    if len(stable) >= STABLE_CACHE:
                        stable.clear()
                    fits = stable[before, i] = self.trace(i) is not None and self.fits(before, i)
                if not fits:
                    continue
            elif self.trace(i) is None:
                continue
            last[j] = i
        return last

    def score_path(self, word: str) -> list[int]:
        """The lightest path by scores; of equals the one whose last piece is
        longest."""
        n, score, ids = len(word), self.vocab.score, self.vocab.ids
        into: list[list] = [[] for _ in range(n + 1)]
        for end, arc in self.pieces.iter(word):
            into[end + 1].append(arc)
        cost, last = [0.0] * (n + 1), [NONE] * (n + 1)
        for j in range(1, n + 1):
            arcs = [(cost[j - size] - score[i], i) for size, i in sorted(into[j], reverse=True)]
            if word[j - 1] not in ids:
                arcs.append((cost[j - 1] + self.unk_cost, BYTES))
            cost[j], last[j] = min(arcs, key=lambda arc: arc[0])
        return last

    def shortest(self, word: str) -> list[int]:
        """Ids on the shortest path of the composition with ``word``."""
        v, out = self.vocab, []
        if self.merges and (SPACE in word[1:] or not self.chars_known):
            # runs of marks merge with equal scores, where only order decides
            for p in self.merged(word):
                out += [v.ids[p]] if p in v.ids else [v.byte_id[b] for b in p.encode()]
            return out
        last, at = (self.merge_path if self.merges else self.score_path)(word), len(word)
        while at:
            i = last[at]
            if i == BYTES:
                out += [v.byte_id[b] for b in reversed(word[at - 1].encode())]
                at -= 1
            else:
                out.append(i)
                at -= len(v.text[i])
        out.reverse()
        return out

    def encode(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        solved = self.solved
        return b"".join([solved[w] for w in self.vocab.words(text)])

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.out.__getitem__, memoryview(ids).cast("I")))
        if self.vocab.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")


def _encoded(batch: pa.RecordBatch, t: Transducer, back: bool = False) -> pa.RecordBatch:
    """Pieces of a batch ``doc_id, text`` and whether decoding gives the text;
    ``back`` keeps the decoded text."""
    n, crc, same, texts, ids = [], [], [], [], []
    for text in batch.column(1).to_pylist():
        raw = t.encode(text or "")
        got = t.decode(raw)
        n.append(len(raw) // 4)
        crc.append(zlib.crc32(raw))
        same.append(got == (text or ""))
        ids.append(raw)
        if back:
            texts.append(got)
    ends = np.cumsum([0, *n])
    if ends[-1] >= 2 ** 31:
        raise ValueError("a batch has more pieces than an Arrow list can hold")
    flat = pa.array(np.frombuffer(b"".join(ids), np.int32))
    cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()),
            pa.array(same, pa.bool_()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
    names = ["doc_id", "n_pieces", "ids_crc32", "decodes", "ids"]
    if back:
        cols, names = [*cols, pa.array(texts, pa.string())], [*names, "decoded"]
    return pa.RecordBatch.from_arrays(cols, names=names)


ENCODED = "doc_id long, n_pieces long, ids_crc32 long, decodes boolean, ids array<int>"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_pieces, ids_crc32, decodes, ids``."""
    return map_batches(_texts(docs, id_col, text_col),
                       lambda batch: _encoded(batch, Transducer.of(model)), ENCODED)


def round_trip(docs: DataFrame, model: str, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """:func:`encode` and the text that its ids decode to, ``decoded``."""
    return map_batches(_texts(docs, id_col, text_col),
                       lambda batch: _encoded(batch, Transducer.of(model), True),
                       ENCODED + ", decoded string")


def decode(rows: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from id arrays."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        t = Transducer.of(model)
        out = [t.decode(array("I", x or []).tobytes()) for x in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())],
                                          names=["doc_id", "text"])

    return map_batches(rows.select(F.col(id_col).cast("long").alias("doc_id"),
                                   F.col(ids_col).cast("array<int>").alias("ids")),
                       run, "doc_id long, text string")
