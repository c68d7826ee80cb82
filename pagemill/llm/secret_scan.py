"""Operator 4: secrets in texts, DataFrame functions only.

Base kinds are patterns (``assign``, ``access``, ``hex``; leftmost,
non-overlapping, short matches dropped).  A battery of randomness tests adds
``random`` spans:

* candidates are runs of 20 or more of ``[A-Za-z0-9+/_-]``; the encoding
  (hex, base32, base36, base62, base64) is inferred from the symbols used;
* chi-squared uniformity over the alphabet, a runs test about the middle of
  the alphabet and a lag-one serial correlation test ask whether the run
  looks uniform; a run that any of them rejects (Bonferroni, ``VETO``) is out;
* the evidence for a run is the likelihood ratio of uniform symbols against
  natural text.  Natural text is words of letters and digits, case folded, by a
  bigram model counted over the words of the whole table (all shorter than a
  candidate, so secrets do not teach it); a symbol's probability is at least
  ``EPS / 36``, which bounds what one odd symbol can prove.  Where separators
  stand and where the case of letters changes is free (paid for by the entropy
  of the run's own pattern), so slugs, paths, CamelCase and CAPITALS are natural;
  so are runs of digits.  The ratio is an e-value: its mean over natural runs is
  at most 1, at every length;
* runs are judged within strata of encoding and length octave.  Within a stratum
  the Benjamini-Hochberg rule for e-values (p = 1 / e) at rate ``FDR`` gives the
  p-value up to which runs are reported.  Ranks come from a histogram over
  p-value bins, so the rule covers every run of the table and the driver
  sees one cut per stratum (at most 5 encodings x 40 octaves) and the at most
  37 x 36 bigram counts.

A ``random`` span that overlaps a base span is left out (it is reported
already).  Positions count code points; ends are exclusive.

Defined cases: null text is empty (no spans); repeated rows are scanned each;
an empty table gives an empty result; a null id is carried through; other
columns are untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

#: The kinds, their patterns, the fewest characters of a match
#: (of group 2 for ``assign``).
ASSIGN = (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"            # maximal runs: the same as + and a length of 24
KINDS = ["assign", "access", "hex", "random"]
MIN_VALUE, MIN_ACCESS = 6, 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
#: Encodings in the order tried: name, pattern, alphabet.
_AZ, _az, _09 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
ENCODINGS = [
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", _09 + "ABCDEF"),
    ("base32", "^[A-Z2-7]+$", _AZ + "234567"),
    ("base36", "^(?:[0-9a-z]+|[0-9A-Z]+)$", _09 + _AZ),
    ("base62", "^[0-9A-Za-z]+$", _AZ + _az + _09),
    ("base64", "", _AZ + _az + _09 + "+/"),
]
#: Symbols of a uniform run (base64 in either form), and the single cases it can have.
CHOICES, CASES = [16, 32, 36, 62, 66], [2, 1, 2, 1, 1]
#: Bigram model: symbols (0 is the start of a word), uniform share, and what a table
#: with few words is taken to hold beside them: so many observations after each symbol,
#: with these shares of digits at the start, after a digit and after a letter.
SYMBOLS, EPS, PRIOR, DIGITS = _09 + _az, 0.05, 100, (0.1, 0.9, 0.03)
VETO = 0.003
FDR = 0.001
BIN, LAST_BIN = 10, 3000          # bins of -10 log10 p


def running(lengths: Column) -> Column:
    """Sum of the items before each item.  Two levels of blocks, so the work
    is n**1.5 for n items, not n**2."""
    block = 256
    zero = F.lit(0).cast("long")

    def prefix(arr: Column) -> Column:
        return F.aggregate(
            arr, F.struct(zero.alias("s"), F.array().cast("array<long>").alias("o")),
            lambda acc, x: F.struct((acc["s"] + x).alias("s"),
                                    F.array_append(acc["o"], acc["s"]).alias("o")))["o"]

    n = F.size(lengths)
    starts = F.sequence(F.lit(0), F.floor((n - 1) / block).cast("int"))
    parts = F.transform(starts, lambda b: F.slice(lengths, b * block + 1, F.lit(block)))
    sums = prefix(F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, x: a + x)))
    joined = F.flatten(F.zip_with(parts, sums, lambda p, s: F.transform(prefix(p), lambda v: v + s)))
    return F.when(n > 0, joined).otherwise(F.array().cast("array<long>"))


def matches(text: Column, pattern: str) -> Column:
    """``array<struct<s, e, t>>`` of the leftmost non-overlapping matches: the
    gaps come from ``split``, the matches from ``regexp_extract_all``, and
    running lengths of both give the positions."""
    got = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    size = F.transform(got, lambda t: F.length(t).cast("long"))
    steps = F.zip_with(F.slice(F.transform(gaps, lambda g: F.length(g).cast("long")),
                               F.lit(1), F.size(got)), size, lambda g, m: g + m)
    ends = F.zip_with(running(steps), steps, lambda before, x: before + x)
    return F.zip_with(ends, got, lambda e, t: F.struct(
        (e - F.length(t)).cast("long").alias("s"), e.cast("long").alias("e"), t.alias("t")))


_NONE = "array<struct<s:bigint,e:bigint,t:string>>"


def _found(text: Column, pattern: str, guard: str) -> Column:
    return F.when(text.rlike(guard), matches(text, pattern)).otherwise(F.array().cast(_NONE))


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["s"].alias("s"), F.lit(kind).alias("k"),
                                                 m["e"].alias("e")))


def _tail(z: Column) -> Column:
    """P(N > z) for the standard normal, z of either sign."""
    a = F.abs(z)
    dens = F.exp(-a * a / 2) / 2.5066282746310002
    far = dens / (a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 5 / (a + 6))))))
    t = 1 / (1 + 0.2316419 * a)
    near = dens * t * (0.319381530 + t * (-0.356563782 + t * (
        1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.when(a > 2, far).otherwise(near)
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _score(m: Column) -> Column:
    """Test statistics of one candidate: start, end, stratum, p-value bin and
    whether it looks uniform."""
    tok = m["t"]
    enc = F.lit(len(ENCODINGS) - 1)
    for i in reversed(range(len(ENCODINGS) - 1)):
        enc = F.when(tok.rlike(ENCODINGS[i][1]), F.lit(i)).otherwise(enc)
    # hex and base36 of either case share one alphabet
    return F.struct(m["s"].alias("s"), m["e"].alias("e"), enc.alias("enc"), tok.alias("t"))


def natural(docs: DataFrame, text_col: str = "text") -> list[float]:
    """Log probability of symbol ``c`` (from 1) after symbol ``p`` (0: first of
    the word) at place ``36 p + c - 1``, counted over all words under 20 long."""
    word = (docs.select(F.explode(F.split(text_or_empty(text_col), "[^A-Za-z0-9]+")).alias("w"))
            .filter(F.length("w").between(1, 19)).groupBy(F.lower("w").alias("w"))
            .agg(F.count(F.lit(1)).alias("n")))
    code = lambda i: F.instr(F.lit(SYMBOLS), F.substring("w", i, F.lit(1)))
    pair = F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.struct(
        F.when(i > 1, code(i - 1)).otherwise(0).alias("p"), code(i).alias("c")))
    got = (word.select("n", F.explode(pair).alias("x")).groupBy("x.p", "x.c")
           .agg(F.sum("n").alias("n")).collect())
    k = len(SYMBOLS)
    table = [[0] * k for _ in range(k + 1)]
    for p, c, n in got:
        table[p][c - 1] = n
    prior = [[PRIOR * d / 10] * 10 + [PRIOR * (1 - d) / 26] * 26 for d in DIGITS]
    kind = [0, *[1] * 10, *[2] * 26]
    return [math.log((1 - EPS) * (n + more) / (sum(row) + PRIOR) + EPS / k)
            for row, i in zip(table, kind) for n, more in zip(row, prior[i])]


def _pattern_cost(some: Column, of: Column) -> Column:
    """Cost (nats) of which ``some`` out of ``of`` places are marked."""
    x = some / of
    return F.log(of + 1) + F.when((some > 0) & (some < of), -of * (
        x * F.log(x) + (1 - x) * F.log(1 - x))).otherwise(0.0)


def _evidence(c: DataFrame, table: list[float]) -> DataFrame:
    """Adds ``gain``: log likelihood ratio of uniform symbols over natural text
    for the run ``t`` of encoding ``enc``; less than 0 for digits only."""
    k = len(SYMBOLS)
    logs = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
    per = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("enc") + 1)
    n = F.length("t")
    c = (c.withColumn("code", F.transform(F.sequence(F.lit(1), n), lambda i: F.instr(
            F.lit(SYMBOLS), F.substring(F.lower("t"), i, F.lit(1)))))
         .withColumn("letters", F.regexp_replace("t", "[^A-Za-z]", "")))
    c = (c.withColumn("words", F.aggregate(F.zip_with(
            F.concat(F.array(F.lit(0)), F.slice("code", F.lit(1), n - 1)), "code",
            lambda p, x: F.when(x > 0, F.element_at(logs, p * k + x)).otherwise(0.0)),
            F.lit(0.0), lambda a, x: a + x))
         .withColumn("seps", F.size(F.filter("code", lambda x: x == 0)))
         .withColumn("turns", F.length(F.regexp_replace(F.regexp_replace(
             "letters", "[A-Z]+", "A"), "[a-z]+", "a")) - 1))
    seps = _pattern_cost(F.col("seps"), n) + F.col("seps") * math.log(4)
    cases = F.when(F.length("letters") > 1, math.log(2) + _pattern_cost(
        F.col("turns"), F.length("letters") - 1)).when(F.length("letters") == 1, math.log(2)).otherwise(0.0)
    cost = F.when(F.col("t").rlike("^[0-9]+$"), F.least(-F.col("words"), n * math.log(10))) \
        .otherwise(-F.col("words") + seps + cases)
    uniform = n * per([math.log(x) for x in CHOICES]) + per(
        [math.log(len(ENCODINGS) * x) for x in CASES])
    return c.withColumn("gain", cost - uniform).drop("code", "letters", "words", "seps", "turns")


def _tests(c: DataFrame, table: list[float]) -> DataFrame:
    """``c`` has one candidate per row: ``enc, t``.  Adds ``octave, bin, ok``;
    ``table`` is the model of natural text."""
    c = _evidence(c, table)
    per = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("enc") + 1)
    c = (c.withColumn("u", F.when(F.col("enc").isin(0, 2), F.upper("t"))
                      .when(F.col("enc") == 4, F.translate("t", "-_", "+/")).otherwise(F.col("t")))
         .withColumn("al", per([a for _, _, a in ENCODINGS]))
         .withColumn("n", F.length("u").cast("double"))
         .withColumn("k", F.length("al").cast("double")))
    c = c.withColumn("sq", F.aggregate(
        F.split("al", ""), F.lit(0.0),
        lambda s, a: s + F.pow(F.length("u") - F.length(F.replace(F.col("u"), a)), F.lit(2))))
    c = c.withColumn("x", F.transform(F.split("u", ""),
                                      lambda ch: F.instr(F.col("al"), ch).cast("double")))
    n, k = F.col("n"), F.col("k")
    c = c.withColumn("chi", k / n * F.col("sq") - n)
    half = F.transform("x", lambda v: F.when(v > k / 2, 1).otherwise(0))
    pairs = lambda a: F.arrays_zip(F.slice(a, F.lit(1), F.size(a) - 1).alias("p"),
                                   F.slice(a, F.lit(2), F.size(a) - 1).alias("q"))
    c = c.withColumn("h", half)
    c = (c.withColumn("n1", F.aggregate("h", F.lit(0), lambda s, v: s + v).cast("double"))
         .withColumn("runs", F.aggregate(F.zip_with(
             F.slice("h", F.lit(1), F.size("h") - 1), F.slice("h", F.lit(2), F.size("h") - 1),
             lambda p, q: F.when(p != q, 1).otherwise(0)), F.lit(1), lambda s, v: s + v)
             .cast("double"))
         .withColumn("mean", F.aggregate("x", F.lit(0.0), lambda s, v: s + v) / n))
    mean = F.col("mean")
    c = (c.withColumn("var", F.aggregate("x", F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean)))
         .withColumn("cov", F.aggregate(F.zip_with(
             F.slice("x", F.lit(1), F.size("x") - 1), F.slice("x", F.lit(2), F.size("x") - 1),
             lambda p, q: (p - mean) * (q - mean)), F.lit(0.0), lambda s, v: s + v)))
    n1 = F.col("n1")
    mu = 2 * n1 * (n - n1) / n + 1
    var = (mu - 1) * (mu - 2) / (n - 1)
    z_chi = (F.col("chi") - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    z_run = F.when(var > 0, F.abs(F.col("runs") - mu) / F.sqrt(var)).otherwise(99.0)
    z_ser = F.when(F.col("var") > 0, F.abs(F.col("cov") / F.col("var")) * F.sqrt(n)).otherwise(99.0)
    uniform = 3 * F.least(_tail(z_chi), 2 * _tail(z_run), 2 * _tail(z_ser)) >= VETO
    return (c.withColumn("octave", F.floor(F.log2("n") * 2).cast("int"))
            .withColumn("bin", F.greatest(F.lit(0), F.least(
                F.floor(F.col("gain") * (BIN / math.log(10))), F.lit(LAST_BIN))).cast("int"))
            .withColumn("ok", uniform))


def cuts(cands: DataFrame) -> list[tuple[int, int, int]]:
    """Smallest p-value bin reported per stratum, by Benjamini-Hochberg with
    p = 1 / e (which holds for e-values however the runs depend).  All runs count as tested; a bin takes part with its largest p-value."""
    hist = cands.groupBy("enc", "octave", "bin").agg(F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window
    w = Window.partitionBy("enc", "octave")
    best = (hist.withColumn("rank", F.sum("n").over(w.orderBy(F.desc("bin"))))
            .withColumn("m", F.sum("n").over(w))
            .filter(F.pow(F.lit(10.0), -F.col("bin") / BIN) <= FDR * F.col("rank") / F.col("m"))
            .groupBy("enc", "octave").agg(F.min("bin").alias("bin")))
    return [tuple(r) for r in best.collect()]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         keep: list[str] | None = None) -> DataFrame:
    """Pass 1, staged: ``row`` (struct of the columns ``keep``; default the id
    as ``doc_id``), ``base`` spans ``(s, k, e)`` and candidates."""
    text = text_or_empty(text_col)
    own = [F.col(c) for c in keep] if keep is not None else [F.col(id_col).alias("doc_id")]
    value = F.regexp_extract
    assign = F.filter(_found(text, ASSIGN, r"(?i)(?:password|passwd|secret|token|api_?key)"
                             r"""["']?\x20*[:=]"""),
                      lambda m: F.length(value(m["t"], ASSIGN, 2)) >= MIN_VALUE)
    access = F.filter(_found(text, ACCESS, "AKIA"), lambda m: m["e"] - m["s"] >= MIN_ACCESS)
    hexes = _found(text, HEX, HEX)
    tokens = F.transform(_found(text, CANDIDATE, CANDIDATE), _score)
    rows = docs.select(F.struct(*own).alias("row"), F.array_sort(F.concat(
        _spans(assign, 0), _spans(access, 1), _spans(hexes, 2))).alias("base"),
        tokens.alias("cand"), F.monotonically_increasing_id().alias("rid"))
    return stage(rows, "secret-rows")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``row``, ``base`` and ``found``: arrays of spans ``(s, k, e)`` by start,
    then kind; ``found`` holds the base spans and the ``random`` ones."""
    rows = scan(docs, id_col, text_col, keep)
    over = lambda b, s, e: (b["s"] < e) & (b["e"] > s)
    free = F.filter("cand", lambda c: ~F.exists("base", lambda b: over(b, c["s"], c["e"])))
    one = rows.select("rid", F.explode(free).alias("c")).select("rid", "c.s", "c.e", "c.enc", "c.t")
    tested = stage(_tests(one, natural(docs, text_col)).select("rid", "s", "e", "enc", "octave", "bin", "ok"),
                   "secret-tested")
    limit = cuts(tested)
    hit = F.lit(False)
    for enc, octave, least in limit:
        hit = hit | ((F.col("enc") == enc) & (F.col("octave") == octave) & (F.col("bin") >= least))
    extra = (tested.filter(hit & F.col("ok")).groupBy("rid")
             .agg(F.collect_list(F.struct("s", F.lit(3).alias("k"), "e")).alias("extra")))
    out = rows.select("row", "rid", "base").join(extra, "rid", "left")
    return out.select("row", "base", F.array_sort(F.concat(
        "base", F.coalesce("extra", F.array().cast("array<struct<s:bigint,k:int,e:bigint>>"))))
        .alias("found"))


def joined(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The query's columns from :func:`detect`."""
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("row.doc_id", count(0).alias("n_assign"), count(1).alias("n_access"),
                        count(2).alias("n_hex"),
                        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
                        joined("found").alias("spans"),
                        F.size(F.filter("found", lambda x: x["k"] == 3)).cast("long")
                        .alias("n_random"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mask``; overlapping spans merge.
    Rows without spans keep their text."""
    cols = docs.columns
    found = detect(docs, text_col=text_col, keep=cols)
    empty = F.array().cast("array<struct<s:bigint,e:bigint>>")
    merged = F.aggregate(
        "found", empty,
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["s"] <= F.element_at(acc, -1)["e"]),
            F.array_append(F.slice(acc, F.lit(1), F.size(acc) - 1), F.struct(
                F.element_at(acc, -1)["s"].alias("s"),
                F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e"))))
        .otherwise(F.array_append(acc, F.struct(x["s"].alias("s"), x["e"].alias("e")))))
    text = F.col("row").getField(text_col)
    n = F.size("m")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.col("m.e"))
    ends = F.concat(F.col("m.s"), F.array(F.length(text).cast("long")))
    clean = F.array_join(F.zip_with(begins, ends, lambda b, e: F.substring(
        text, (b + 1).cast("int"), (e - b).cast("int"))), mask)
    new = F.when(n > 0, clean).otherwise(text)
    return found.withColumn("m", merged).select(*[
        (new if c == text_col else F.col("row").getField(c)).alias(c) for c in cols])
