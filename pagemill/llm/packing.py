"""Operator 5: packing token sequences by bin completion.

Texts are tokenised once; a document's ids end with id 0, and only documents
longer than the capacity are cut.  A packing depends on piece lengths alone,
so the search runs on the histogram of lengths: at most ``CAPACITY`` numbers,
however large the corpus.

* Incumbent: best fit decreasing on the histogram, many equal bins at a time.
* If it exceeds the lower bound, bin completion looks for a better packing:
  take the largest length left, enumerate the undominated fillings of the rest
  of its bin (no unused length fits the slack, and none can replace a used
  length or a pair of them), least waste first, apply a filling as often as
  the counts allow, and prune when the waste so far exceeds what one bin fewer
  than the incumbent leaves.  ``NODES`` bounds the search; the best packing
  found is returned either way.

The result is a list of patterns with multiplicities, at most a few per
length.  Pieces take slots by their rank among the pieces of equal length;
ranks are prefix sums over hashed buckets, so a length that a third of the
pieces share spreads over many tasks.

Defined cases: null text counts as empty (the single id 0); repeated rows are
pieces of their own; rows with a null id are packed too; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import bisect
import os
import unicodedata
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, stage

CAPACITY = 2048
END = 0
#: Steps of the search: lengths and fillings looked at, some seconds in all.
WORK = 1_000_000
#: Fillings tried per node, and entries in a worker's cache of words.
WIDTH = 8
CACHE = 600_000

Pattern = tuple[int, list[tuple[int, int]]]     # bins, (length, pieces a bin)


class Tokens:
    """Ids of whole texts as little-endian 32-bit bytes.

    The normaliser and pre-tokeniser of the vocabulary never join characters
    across white space, so a text is the concatenation of its words and words
    are cached.  Letters in lower case, with or without closing stops, are the
    rule: a letter and a stop are separate words of the pre-tokeniser, and the
    letters go to the model directly.  Other new words are encoded many at a
    time, with a mark between them whose one id tells where a word ends.  Texts
    with a separator on which Python and the tokenizer disagree (1C-1F) are
    encoded whole."""

    _loaded: dict[str, Tokens] = {}
    ODD = "\x1c\x1d\x1e\x1f"
    MARK = "|"
    STOPS = ".,;:!?"
    #: The byte-level alphabet: printable bytes stand for themselves, the others
    #: follow from code point 256.
    PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
    BYTES = dict(zip([*PLAIN, *sorted(set(range(256)) - set(PLAIN))],
                     map(chr, [*PLAIN, *range(256, 256 + 256 - len(PLAIN))])))

    def __init__(self, path: str):
        # a task has one core: the library's own threads would only wait
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        mark = self.tok.encode(self.MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None

    @classmethod
    def of(cls, path: str) -> Tokens:
        """One per worker process and vocabulary; it outlives the task."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _encode(self, words: list[str]) -> list[bytes]:
        got = self.tok.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in got]

    def _letters(self, word: str) -> bytes | None:
        """Ids of lower-case letters in composed form; None for other words."""
        if not word.isascii():
            if not (word.islower() and word.isalpha() and unicodedata.is_normalized("NFC", word)) \
                    or word.lower() != word:
                return None
            word = "".join(map(self.BYTES.__getitem__, word.encode()))
        elif not word.isalpha():
            return None
        return array("I", [t.id for t in self.tok.model.tokenize(word)]).tobytes()

    def _learn(self, words: set[str]) -> None:
        if len(self.parts) > CACHE:
            self.parts.clear()
        known, parts, stops = self.known, self.parts, self.STOPS
        others = []
        for word in words:
            core = word.rstrip(stops)
            low = core.lower() if core.isascii() else core
            ids = parts.get(low)
            if ids is None:
                ids = self._letters(low) if low else None
                if ids is None:
                    others.append(word)
                    continue
                parts[low] = ids
            if len(core) < len(word):
                end = word[len(core):]
                if end not in parts:
                    parts[end] = self._encode([end])[0]
                ids += parts[end]
            known[word] = ids
        alone = [w for w in others if self.MARK in w or self.mark is None]
        known.update(zip(alone, self._encode(alone)))
        many = [w for w in others if not (self.MARK in w or self.mark is None)]
        groups = [many[i:i + 512] for i in range(0, len(many), 512)]
        for group, raw in zip(groups, self._encode([f" {self.MARK} ".join(g) for g in groups])):
            ends = 4 * np.flatnonzero(np.frombuffer(raw, "<u4") == self.mark)
            if len(ends) != len(group) - 1:
                raise ValueError("the mark of the vocabulary is not a token of its own")
            starts = [0, *(ends + 4).tolist()]
            known.update((w, raw[i:j]) for w, i, j in zip(group, starts, [*ends.tolist(), len(raw)]))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 128):
            part = texts[at:at + 128]
            if len(self.known) > CACHE:
                self.known.clear()
            words = [None if any(c in t for c in self.ODD) else t.split() for t in part]
            new = set().union(*filter(None, words)).difference(self.known)
            if new:
                self._learn(new)
            get = self.known.__getitem__
            for t, w in zip(part, words):
                yield self._encode([t])[0] if w is None else b"".join(map(get, w))


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``."""
    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        tok = Tokens.of(tokenizer)
        out: list[list] = [[], [], [], [], []]
        ids = batch.column(0).to_pylist()
        end = np.array([END], "<u4").tobytes()
        texts = [t or "" for t in batch.column(1).to_pylist()]
        for doc, raw in zip(ids, tok.encode(texts)):
            raw += end
            for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[at:at + 4 * capacity]
                for col, v in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part))):
                    col.append(v)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(out, kinds)],
            names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return map_batches(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                   F.col(text_col).cast("string").alias("text")), cut,
                       "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(hist: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Best fit decreasing over a histogram, equal bins taken together."""
    open_: dict[int, list[list]] = {}           # room -> [bins, filling]
    rooms: list[int] = []

    def put(room: int, bins: int, filling: list) -> None:
        if room not in open_:
            open_[room] = []
            bisect.insort(rooms, room)
        open_[room].append([bins, filling])

    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                bins, filling = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            else:
                room, filling = capacity, []
                bins = -(-left // (room // length))
            each = min(room // length, left)
            full = min(bins, left // each)
            put(room - each * length, full, filling + [(length, each)])
            left -= full * each
            if bins > full:
                put(room, bins - full, filling)
    return [(bins, filling) for stack in open_.values() for bins, filling in stack if filling]


def lower_bound(hist: dict[int, int], capacity: int = CAPACITY) -> int:
    """The best of: the volume; Martello and Toth's L2 (pieces over half a bin,
    plus the volume that cannot join them); and, for every k, the volume after
    rounding by the dual feasible function u(k), which counts a piece as
    ``floor((k + 1) x) / k`` of a bin, or as x where ``(k + 1) x`` is whole."""
    x = np.array(sorted(k for k, n in hist.items() if n), np.int64)
    if not len(x):
        return 0
    n = np.array([hist[int(v)] for v in x], np.int64)
    count, volume = np.append(0, np.cumsum(n)), np.append(0, np.cumsum(x * n))
    best = -(-int(volume[-1]) // capacity)
    half = np.searchsorted(x, capacity // 2, "right")
    k = np.append(0, x[:half])
    from_k = np.searchsorted(x, k, "left")
    over = np.searchsorted(x, capacity - k, "right")
    mid = count[over] - count[half]
    room = mid * capacity - (volume[over] - volume[half])
    small = volume[half] - volume[from_k]
    best = max(best, int((count[-1] - count[over] + mid + np.maximum(0, -(-(small - room) // capacity))).max()))
    for f in range(1, 201):
        part = (f + 1) * x
        share = np.where(part % capacity == 0, f * x, part // capacity * capacity)   # times f * capacity
        best = max(best, -(-int((share * n).sum()) // (f * capacity)))
    return best


def fillings(lengths: list[int], counts: dict[int, int], room: int,
             steps: int = 2000) -> tuple[list[tuple[int, ...]], int]:
    """Undominated fillings of ``room``, least waste first, at most WIDTH, and
    the steps taken.  ``lengths`` ascending, all with a positive count."""
    found: list[tuple[int, tuple[int, ...]]] = []
    todo: list[tuple[tuple[int, ...], int, int]] = [((), room, room)]
    spent = 0
    while todo and spent < steps:
        chosen, left, top = todo.pop()
        spent += 1
        at = bisect.bisect_right(lengths, min(left, top)) - 1
        more = []
        for i in range(at, max(-1, at - 2 * WIDTH), -1):
            x = lengths[i]
            if chosen.count(x) < counts[x]:
                more.append(((*chosen, x), left - x, x))
                if left == x:
                    break
        if not more:
            found.append((left, chosen))
        todo.extend(reversed(more))          # the largest is tried first

    def dominated(slack: int, chosen: tuple[int, ...]) -> bool:
        have = Counter(chosen)
        pairs = {a + b for a in have for b in have if a < b or (a == b and have[a] > 1)}
        for g in {0, *have, *pairs}:
            at = bisect.bisect_right(lengths, g + slack) - 1
            while at >= 0 and lengths[at] > g:
                if counts[lengths[at]] > have[lengths[at]]:
                    return True
                at -= 1
        return False

    best = sorted(set(found))
    good = [f for f in best[:8 * WIDTH] if not dominated(*f)] or best[:1]
    return [f for _, f in good[:WIDTH]], spent


class Plan(list):
    """Patterns with multiplicities, and what is known of their number:
    ``bins``, the lower ``bound``, ``proved`` (no packing has fewer bins)."""

    def __init__(self, patterns: list[Pattern], bound: int):
        super().__init__(patterns)
        self.bins = sum(b for b, _ in patterns)
        self.bound, self.proved = bound, self.bins == bound


def bin_completion(hist: dict[int, int], capacity: int = CAPACITY, work: int = WORK) -> Plan:
    """The best packing found with ``work`` steps."""
    hist = {k: n for k, n in hist.items() if n}
    incumbent = best_fit(hist, capacity)
    size = lambda plan: sum(b for b, _ in plan)
    fewest = size(incumbent)
    bound, total = lower_bound(hist, capacity), sum(k * n for k, n in hist.items())
    # depth-first over (counts, plan, bins, waste); the last entry is expanded
    stack = [(hist, [], 0, 0)]
    nodes = 0
    while stack and work > 0 and fewest > bound:
        counts, plan, bins, waste = stack.pop()
        nodes += 1
        work -= len(counts) + 1
        allowed = (fewest - 1) * capacity - total
        if waste > allowed:
            continue
        # best fit from here on is a full solution as well
        if bins and nodes % 16 == 0:
            tail = best_fit(counts, capacity)
            work -= 8 * len(counts)
            if bins + size(tail) < fewest:
                incumbent = plan + tail
                fewest = size(incumbent)
                continue
        if not counts:
            if bins < fewest:
                incumbent, fewest = plan, bins
            continue
        lengths = sorted(counts)
        top = lengths[-1]
        rest = dict(counts)
        rest[top] -= 1
        avail = [x for x in lengths if rest[x]]
        nxt = []
        steps = min(2000, work)
        found, spent = fillings(avail, rest, capacity - top, steps)
        work -= 4 * spent
        for f in found:
            used = {top: 1}
            for x in f:
                used[x] = used.get(x, 0) + 1
            most = min(counts[x] // q for x, q in used.items())
            # as often as the counts allow first, then once
            for times in dict.fromkeys((most, 1)):
                lost = waste + times * (capacity - sum(x * q for x, q in used.items()))
                if lost > allowed:
                    continue
                after = {x: n - times * used.get(x, 0) for x, n in counts.items()
                         if n - times * used.get(x, 0)}
                work -= len(counts)
                nxt.append((after, [*plan, (times, sorted(used.items(), reverse=True))],
                            bins + times, lost))
        stack.extend(reversed(nxt))
    return Plan(incumbent, bound)


def slots(plan: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, pieces a bin, first sequence and offset."""
    table: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    base = 0
    for bins, filling in plan:
        offset = 0
        for length, each in filling:
            first = taken.get(length, 0)
            table.setdefault(length, []).append((first, each, base, offset))
            taken[length] = first + bins * each
            offset += length * each
        base += bins
    return {k: tuple(np.array(c, np.int64) for c in zip(*rows)) for k, rows in table.items()}


def _ranked(cut: DataFrame) -> DataFrame:
    """``cut`` plus ``rank``: 0, 1, ... among pieces of equal length."""
    buckets = max(64, cut.count() // 2000)
    b = cut.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    each = b.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("length").orderBy("bucket")
    before = stage(each.withColumn("before", F.sum("n").over(w) - F.col("n"))
                   .select("length", "bucket", "before"), "pack-before")
    inner = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")
    return (b.withColumn("own", F.row_number().over(inner))
            .join(before, ["length", "bucket"])
            .withColumn("rank", F.col("before") + F.col("own") - 1)
            .select("doc_id", "piece", "start", "length", "ids_crc32", "rank"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece with its sequence and offset."""
    cut = stage(pieces(docs, tokenizer, id_col, text_col, capacity), "pack-pieces")
    hist = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}   # <= capacity rows
    # the plan has a few slots per length, so its size is bounded by the capacity
    where = docs.sparkSession.sparkContext.broadcast(slots(bin_completion(hist, capacity)))

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length = batch.column(3).to_numpy()
        rank = batch.column(5).to_numpy()
        seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for x in np.unique(length):
            first, each, base, offset = where.value[int(x)]
            mine = length == x
            r = rank[mine]
            s = np.searchsorted(first, r, "right") - 1
            k = r - first[s]
            seq[mine] = base[s] + k // each[s]
            off[mine] = offset[s] + k % each[s] * x
        cols = [batch.column(i) for i in range(5)]
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(seq), pa.array(off)],
            names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return map_batches(_ranked(cut), place, "doc_id long, piece int, start long, length long, "
                       "ids_crc32 long, sequence_id long, offset long")
