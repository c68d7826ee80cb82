"""Operator 9: token counts without tokens.

A unigram vocabulary segments a text by the best sum of piece scores.  The
Aho-Corasick automaton of the pieces lists every match by its end; dynamic
programming over ends carries the best score and the number of pieces on that
path, nothing else.  Rules of the tokenizer: a later start replaces an earlier
one only with a strictly better score (so the longest piece wins a tie); a
character that is no piece of its own gets an unknown node, ten below the worst
piece, which counts as its UTF-8 bytes.  Sums are in double precision.

Any SentencePiece vocabulary with byte fallback serves; its scores are used as
they are, also where the file says that the model was trained by merges.

Defined cases: null or empty text has 0 tokens and score 0; repeated rows are
counted each; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches
from .pieces import UNKNOWN_PENALTY, Cached, Vocabulary


class Counter:
    _made: dict[str, Counter] = {}

    def __init__(self, proto: bytes):
        self.vocab = v = Vocabulary(proto)
        self.auto = ahocorasick.Automaton()
        for piece, i in v.ids.items():
            self.auto.add_word(piece, (len(piece), v.score[i]))
        self.auto.make_automaton()
        self.unk = v.worst - UNKNOWN_PENALTY
        self.solved = Cached(self.best)

    @classmethod
    def of(cls, path: str) -> Counter:
        if path not in cls._made:
            cls._made[path] = cls(open(path, "rb").read())
        return cls._made[path]

    def best(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best path over a normalised text."""
        n = len(text)
        score = [0.0] + [None] * n
        count = [0] * (n + 1)
        ends: list[list] = [[] for _ in range(n + 1)]
        for last, (size, s) in self.auto.iter(text):
            ends[last + 1].append((size, s))
        for e in range(1, n + 1):
            best, pieces, single = None, 0, False
            # longest first, that is by rising start
            for size, s in sorted(ends[e], reverse=True):
                single = single or size == 1
                here = score[e - size] + s
                if best is None or here > best:
                    best, pieces = here, count[e - size] + 1
            if not single:
                here = score[e - 1] + self.unk
                if best is None or here > best:
                    best, pieces = here, count[e - 1] + len(text[e - 1].encode())
            score[e], count[e] = best, pieces
        return count[n], score[n]

    def count(self, text: str) -> tuple[int, float]:
        got = [self.solved[w] for w in self.vocab.words(text)]
        return sum(c for c, _ in got), sum(s for _, s in got)


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, score``.  ``model`` is a path on every executor."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        c = Counter.of(model)
        got = [c.count(t or "") for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([g[0] for g in got], pa.int64()),
             pa.array([float(g[1]) for g in got], pa.float64())],
            names=["doc_id", "n_tokens", "score"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                   F.col(text_col).cast("string").alias("text")),
                       run, "doc_id long, n_tokens long, score double")
