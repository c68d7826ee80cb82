"""Operator 3: near-duplicate documents by b-bit MinHash, confirmed exactly.

A document's set holds the distinct 64-bit hashes of its 5-word shingles
(ASCII lower case, words ``[^\\x20\\x09-\\x0D]+``); with fewer than five
words the whole sequence is the one shingle; without words the set is empty
and links with nothing.  Two documents are linked when
``100 * |A & B| >= 75 * |A | B|``; components are taken over links.

1. ``HASHES`` minima per document; 32 bands of 4 give 32 candidate keys (a
   pair at similarity 0.75 misses all of them with probability 5e-6).  Of each
   minimum the low ``B`` bits are kept, packed into 64-bit words.
2. Equal sets collapse to one representative, so copies cost one row each.
3. In each band group every member is paired with a hub (a star: linear in the
   group): the member with the most company over all its bands, that is the
   likely original, then the smallest id.  The packed signatures estimate the
   similarity, corrected for chance agreement of ``B`` bits.  Pairs under
   ``NEAR`` are far; the others are compared on the full sets, which also
   gives each member's novel shingles, those that the hub lacks.
4. What the stars leave open is finished without pairing whole groups.  A link
   of u and c needs ``3 / 7 * (|u| + |c|)`` common shingles; at most
   ``min(|u & hub|, |c & hub|)`` of them are the hub's, so the others are common
   novel shingles.  With k of them needed, the shingles other than the ``k - 1``
   most frequent of u and those of c have one in common.  Members that the hub
   did not link and all near members meet by these rare shingles: first each of
   the former with one holder of the shingle (a second star), then, across the
   components that are left, with all holders.  Pairs for which the hub's part
   could suffice meet directly.  Of these pairs only those leave the join whose
   marks allow a link: ``MARKS`` bits for the hub's shingles that a member lacks
   and as many for its novel ones.  The hub's part of a pair is at most the hub
   without the marked ones of either; a novel shingle whose mark the other does
   not have is not common.
5. Far members of a group are estimated against all its unlinked members of
   other components, in small groups by a join, in groups over ``SMALL`` members
   block by block, so no task holds more than two blocks.  A far member cannot
   be linked to those linked with the hub (distances 1 - J add up; NEAR is more
   than two standard deviations under the 0.5 that this takes).

   Candidates over ``FLOOR`` (more than six standard deviations under 0.75)
   are confirmed on full sets.  No partner or candidate is dropped.

Defined cases: null text is empty; repeated ids count as one document whose
rows share a component when their sets are equal or similar, and each input
row gives a result row; rows with a null id are reported alone (component
null); an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, map_batches, stage, text_or_empty

#: Words in a shingle; similarity in percent.
WORDS = 5
PERCENT = 75
HASHES, BANDS, B = 128, 32, 2
FLOOR = 0.45
NEAR = 0.35
#: Members of a band group up to which its remaining pairs come from a join;
#: members in a block beyond that.
SMALL, BLOCK = 64, 512
#: Bits that mark the shingles a member lacks of its hub, and its novel ones.
MARKS = 256

_U = np.uint64
_rng = np.random.RandomState(20240501)
_A = (_rng.randint(0, 1 << 31, HASHES).astype(np.uint32) << np.uint32(1)) | np.uint32(1)
_C = _rng.randint(0, 1 << 31, HASHES).astype(np.uint32)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_set(text: bytes) -> np.ndarray:
    """Sorted distinct shingle hashes of a UTF-8 text."""
    words = text.lower().split()          # bytes: ASCII letters and blanks only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(WORDS, n)
    acc = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        acc = acc * _U(0x9E3779B97F4A7C15) + h[j:n - k + 1 + j]
        acc ^= acc >> _U(29)
    return np.unique(_mix(acc))


def minima(s: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a non-empty set."""
    x = (s ^ (s >> _U(32))).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(out, (x[None, i:i + 2048] * _A[:, None] + _C[:, None]).min(axis=1), out=out)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    """(docs, BANDS) keys; the band number is part of the key."""
    m = mins.astype(np.uint64).reshape(len(mins), BANDS, HASHES // BANDS)
    acc = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), m.shape[:2])
    for j in range(m.shape[2]):
        acc = _mix(acc * _U(0x9E3779B97F4A7C15) + m[:, :, j])
    return acc.view(np.int64)


def pack(mins: np.ndarray) -> np.ndarray:
    """(docs, HASHES * B / 64) words with the low B bits of each minimum.
    Minima are scrambled first: their own low bits depend on few input bits."""
    low = _mix(mins.astype(np.uint64)) & _U((1 << B) - 1)
    per = 64 // B
    low = low.reshape(len(mins), HASHES // per, per) << (np.arange(per, dtype=np.uint64) * _U(B))
    return np.bitwise_or.reduce(low, axis=2).view(np.int64)


def _lists(a: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, a.size + 1, a.shape[1], dtype=np.int32),
                                    pa.array(a.reshape(-1), pa.int64()))


def _sign(batch: pa.RecordBatch) -> pa.RecordBatch:
    sizes, hi, lo = [], [], []
    mins = np.full((batch.num_rows, HASHES), 0xFFFFFFFF, np.uint32)
    for i, t in enumerate(batch.column(1)):
        s = shingle_set(t.as_py())
        sizes.append(len(s))
        d = xxhash.xxh3_128_intdigest(s.tobytes())
        hi.append((d >> 64) - (1 << 63))
        lo.append((d & ((1 << 64) - 1)) - (1 << 63))
        if len(s):
            mins[i] = minima(s)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(sizes, pa.int64()), pa.array(hi, pa.int64()),
         pa.array(lo, pa.int64()), _lists(band_keys(mins)), _lists(pack(mins))],
        names=["doc_id", "n_shingles", "hi", "lo", "bands", "sig"])


def sign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Set size, 128-bit digest of the set, band keys and packed bits."""
    return map_batches(
        docs.select(F.col(id_col).cast("long").alias("doc_id"),
                    text_or_empty(text_col).cast("binary").alias("text")),
        _sign, "doc_id long, n_shingles long, hi long, lo long, bands array<long>, sig array<long>")


def estimate(sa: str, sb: str):
    """Similarity from the packed bits: share of agreeing B-bit fields,
    corrected for the 2**-B that agree by chance."""
    field = sum(1 << (B * i) for i in range(64 // B))
    lows = int(np.array([field], np.uint64).view(np.int64)[0])
    words = HASHES * B // 64
    diff = None
    for w in range(words):
        x = F.col(sa)[w].bitwiseXOR(F.col(sb)[w])
        folded = x
        for s in range(1, B):
            folded = folded.bitwiseOR(F.shiftrightunsigned(x, s))
        n = F.bit_count(folded.bitwiseAND(F.lit(lows)))
        diff = n if diff is None else diff + n
    chance = 2.0 ** -B
    return (1 - diff / float(HASHES) - chance) / (1 - chance)


def _marked(places: np.ndarray) -> np.ndarray:
    bits = np.zeros(MARKS, bool)
    bits[places % MARKS] = True
    return np.packbits(bits, bitorder="little").view("<i8")


def marks(x: np.ndarray, y: np.ndarray, novel: np.ndarray) -> np.ndarray:
    """``2 * MARKS`` bits in words: places in ``y`` of its shingles that ``x``
    lacks, then the shingles ``novel`` of ``x``; places beyond share bits."""
    lost = np.flatnonzero(~np.isin(y, x, assume_unique=True))
    return np.concatenate([_marked(lost), _marked(novel)])


def _compare(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Exact comparison of two texts per row; ``novel``: shingles of a that b
    lacks; ``marks`` of both differences."""
    cols, last = [[], [], [], [], []], (None, None)
    for i in range(batch.num_rows):
        b = batch.column(3)[i].as_py()
        if last[0] != b:
            last = (b, shingle_set(b))
        x, y = shingle_set(batch.column(2)[i].as_py()), last[1]
        novel = np.setdiff1d(x, y, assume_unique=True)
        for c, v in zip(cols, (len(x), len(y), len(x) - len(novel), novel.view(np.int64),
                               marks(x, y, novel))):
            c.append(v)
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), *[pa.array(c, pa.int64()) for c in cols[:3]],
         *[pa.array(c, pa.list_(pa.int64())) for c in cols[3:]]],
        names=["a", "b", "na", "nb", "both", "novel", "marks"])


def _near(pairs: DataFrame, sigs: DataFrame, floor: float) -> DataFrame:
    """The pairs ``(a, b)`` whose estimated similarity reaches ``floor``."""
    sa = sigs.select(F.col("doc_id").alias("a"), F.col("sig").alias("sa"))
    sb = sigs.select(F.col("doc_id").alias("b"), F.col("sig").alias("sb"))
    return (pairs.join(sa, "a").join(sb, "b")
            .filter(estimate("sa", "sb") >= floor).select("a", "b"))


def _compared(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    ta = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    full = pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb")
    out = map_batches(full, _compare,
                      "a long, b long, na long, nb long, both long, novel array<long>, marks array<long>")
    return out.withColumn("linked", F.expr(f"100 * both >= {PERCENT} * (na + nb - both)"))


def _may_link() -> Column:
    """Whether two members ``u`` and ``c`` of one hub can be linked, by their sizes
    (``n``), common shingles with the hub (``b``) and marks (``m``); ``nb``: the
    hub's size.  Never false for a link."""
    words = MARKS // 64

    def bits(first: int, merge: str) -> str:
        return " + ".join(f"bit_count({merge.format(u=f'mu[{i}]', c=f'mc[{i}]')})"
                          for i in range(first, first + words))

    hub = f"least(bu, bc, nb - ({bits(0, '{u} | {c}')}))"
    novel = (f"least(nu - bu - ({bits(words, '{u} & ~{c}')}), nc - bc - ({bits(words, '{c} & ~{u}')}))")
    return F.expr(f"7 * ({hub} + {novel}) >= 3 * (nu + nc)")


def _meetings(checked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Where near members of a hub can meet that a star did not link.

    ``asks (b, sh, u, small)``: rare novel shingles of the members ``u`` that hub
    ``b`` did not link; ``has (b, sh, c, small)``: rare novel shingles of all near
    members ``c``.  A link of u and c that the hub's part cannot give shares a
    shingle of both (``small``: that of c below the hub's size).  ``inside
    (u, c)``: pairs where the hub's part could suffice, as members ``(b, u, nu,
    bu)`` to meet ``(b, c, nc, bc)``."""
    open_hubs = stage(checked.filter("not linked").select("b").distinct(), "near-open-hubs")
    own = stage(checked.join(open_hubs, "b", "left_semi"), "near-open-stars")
    # what the hub's part of any open member can give: 3 * (nu + nc) / 7 <= bu
    room = stage(own.filter("not linked").groupBy("b")
                 .agg(F.max(F.floor(F.col("both") * 7 / 3) - F.col("na")).alias("most")), "near-room")
    three_quarters = F.ceil(F.col("na") * 3 / 4)
    rows = own.join(room, "b").select(
        "a", "b", "linked", (F.col("na") < F.col("nb")).alias("small"), F.size("novel").alias("nn"),
        # at least this many common novel shingles: with a partner no smaller than
        # the hub, with any partner, and with any open member
        (F.ceil(3 * (F.col("na") + F.greatest("nb", three_quarters)) / 7) - F.col("both")).alias("need"),
        (F.ceil(3 * (F.col("na") + three_quarters) / 7) - F.col("both")).alias("need_any"),
        F.ceil(3 * (F.col("na") - F.col("most")) / 7).alias("need_open"),
        F.explode("novel").alias("sh"))
    rows = stage(rows, "near-novel")
    freq = stage(rows.groupBy("b", "sh").agg(F.count(F.lit(1)).alias("f")).filter("f >= 2"),
                 "near-freq")
    w = Window.partitionBy("b", "a")
    rows = stage(rows.join(freq, ["b", "sh"])
                 .withColumn("rank", F.row_number().over(w.orderBy("f", "sh")))
                 .withColumn("alone", F.col("nn") - F.count(F.lit(1)).over(w)), "near-shared")

    def rare(need: str) -> Column:
        return F.expr(f"rank + alone <= nn - greatest({need}, 1) + 1")

    asks = rows.filter("not linked").withColumn("large", rare("need")).withColumn("any", rare("need_any"))
    asks = stage(asks.filter("large or any").select("b", "sh", F.col("a").alias("u"), "large", "any"), "near-asks")
    has = stage(rows.filter(rare("need_open")).select("b", "sh", F.col("a").alias("c"), "small"), "near-has")
    return asks, has, own.join(room, "b")


def _labelled(rows: DataFrame, comp: DataFrame, col: str) -> DataFrame:
    """``rows`` plus ``comp_<col>``, the component of that column."""
    return (rows.join(comp.select(F.col("id").alias(col), F.col("comp").alias(f"comp_{col}")), col, "left")
            .withColumn(f"comp_{col}", F.coalesce(f"comp_{col}", col)))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.greatest("u", "c").alias("a"), F.least("u", "c").alias("b")).distinct()


def _second_stars(asks: DataFrame, has: DataFrame) -> DataFrame:
    """Every asking member with one holder of each rare shingle, the holder of
    most of them: linear in the rows."""
    most = has.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    hub = (has.join(most, "c").groupBy("b", "sh", "n").agg(F.min("c").alias("c"))
           .groupBy("b", "sh").agg(F.max_by("c", "n").alias("c")))
    return _ordered(asks.join(stage(hub, "near-second-hubs"), ["b", "sh"]).filter("u != c").select("u", "c"))


def _member(own: DataFrame, x: str, *more: str) -> DataFrame:
    """What :func:`_may_link` reads of a member, named ``x``."""
    return own.select("b", F.col("a").alias(x), F.col("na").alias(f"n{x}"), F.col("both").alias(f"b{x}"),
                      F.col("marks").alias(f"m{x}"), *more)


def _by_novel(asks: DataFrame, has: DataFrame, own: DataFrame, comp: DataFrame) -> DataFrame:
    """Candidate pairs across components that the stars and second stars left."""
    asks = stage(_labelled(asks, comp, "u"), "near-asks-comp")
    has = stage(_labelled(has, comp, "c"), "near-has-comp")
    mixed = stage(asks.select("b", "sh", F.col("comp_u").alias("comp"))
                  .unionByName(has.select("b", "sh", F.col("comp_c").alias("comp")))
                  .groupBy("b", "sh").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"))
                  .filter("c0 < c1").select("b", "sh"), "near-mixed")
    asks = stage(asks.join(mixed, ["b", "sh"], "left_semi")
                 .join(_member(own, "u", "nb"), ["b", "u"]), "near-asks-mixed")
    has = stage(has.join(mixed, ["b", "sh"], "left_semi").join(_member(own, "c"), ["b", "c"]), "near-has-mixed")
    fits = F.when(F.col("small"), F.col("any")).otherwise(F.col("large"))
    shared = (asks.join(has, ["b", "sh"])
              .filter((F.col("comp_u") != F.col("comp_c")) & fits & _may_link()).select("u", "c"))
    # where the hub's part could suffice: 3 * (nu + nc) <= 7 * min(bu, bc)
    u = _labelled(_member(own.filter("not linked"), "u", "nb"), comp, "u")
    c = _labelled(_member(own.filter("na < nb and na <= most"), "c"), comp, "c")
    inside = (stage(u, "near-inside-u").join(stage(c, "near-inside-c"), "b")
              .filter(F.expr("comp_u != comp_c and 3 * (nu + nc) <= 7 * least(bu, bc) "
                             "and 4 * nc >= 3 * nu and 4 * nu >= 3 * nc") & _may_link()).select("u", "c"))
    return _ordered(shared.unionByName(inside))


def _across(block: pd.DataFrame) -> pd.DataFrame:
    """Candidate pairs between different components of two blocks of one band
    group, by packed bits.  Members of one block meet in its own (i, i) task."""
    lo, hi = block["lo"].iloc[0], block["hi"].iloc[0]
    left, right = block[block["i"] == lo], block[block["i"] == hi]
    none = pd.DataFrame({"a": pd.Series(dtype="int64"), "b": pd.Series(dtype="int64")})
    if block["comp"].nunique() < 2 or not block["far"].any():
        return none
    sl = np.stack(left["sig"].to_numpy()).astype(np.int64).view(np.uint64)
    sr = np.stack(right["sig"].to_numpy()).astype(np.int64).view(np.uint64)
    lows = _U(sum(1 << (B * i) for i in range(64 // B)))
    cl, cr = left["comp"].to_numpy(), right["comp"].to_numpy()
    il, ir = left["doc_id"].to_numpy(), right["doc_id"].to_numpy()
    fl, fr = left["far"].to_numpy(), right["far"].to_numpy()
    out_a, out_b = [], []
    most = HASHES * (1 - (FLOOR * (1 - 2.0 ** -B) + 2.0 ** -B))
    for x, c, d, far in zip(sl, cl, il, fl):
        v = sr ^ x
        f = v
        for s in range(1, B):
            f = f | (v >> _U(s))
        diff = np.bitwise_count(f & lows).sum(axis=1)
        hit = (diff <= most) & (cr != c) & (fr | far)
        if lo == hi:
            hit &= ir > d
        other = ir[hit]
        out_a.append(np.maximum(other, d))
        out_b.append(np.minimum(other, d))
    if not out_a:
        return none
    return pd.DataFrame({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})


def _by_groups(far: DataFrame, comp: DataFrame, sigs: DataFrame) -> DataFrame:
    """Candidate pairs across components among the unlinked members ``(key,
    doc_id, far)`` of band groups, at least one of them far (all, without that
    column)."""
    if "far" not in far.columns:
        far = far.withColumn("far", F.lit(True))
    m = stage(far.join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
              .select("key", "doc_id", "far", F.coalesce("comp", "doc_id").alias("comp")), "near-far")
    open_ = stage(m.groupBy("key")
                  .agg(F.count(F.lit(1)).alias("n"), F.min("comp").alias("c0"),
                       F.max("comp").alias("c1"), F.max("far").alias("some"))
                  .filter("c0 < c1 and some").select("key", "n"), "near-open")
    m = stage(m.join(open_, "key"), "near-open-members")
    few = m.filter(F.col("n") <= SMALL)
    x = few.select("key", F.col("doc_id").alias("a"), F.col("comp").alias("ca"), F.col("far").alias("fa"))
    y = few.select("key", F.col("doc_id").alias("b"), F.col("comp").alias("cb"), F.col("far").alias("fb"))
    small = x.join(y, "key").filter("a > b and ca != cb and (fa or fb)").select("a", "b")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    many = (m.filter(F.col("n") > SMALL).join(sigs.select("doc_id", "sig"), "doc_id")
            .withColumn("i", F.pmod(F.xxhash64("doc_id"), blocks).cast("int"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("key", "doc_id", "comp", "far", "sig", "i",
                    F.least("i", "j").alias("lo"), F.greatest("i", "j").alias("hi")))
    large = many.groupBy("key", "lo", "hi").applyInPandas(_across, "a long, b long")
    return small.unionByName(large).distinct()


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per input row."""
    signed = stage(sign(docs, id_col, text_col), "near-signed")
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    reps = stage(some.groupBy("hi", "lo").agg(F.min("doc_id").alias("rep")), "near-reps")
    # one row per distinct set: the rows of a representative
    own = stage(some.join(reps.select("hi", "lo", F.col("rep").alias("doc_id")),
                          ["hi", "lo", "doc_id"], "left_semi")
                .select("doc_id", "hi", "lo", "bands", "sig")
                .dropDuplicates(["hi", "lo"]), "near-own")
    keys = stage(own.select("doc_id", F.explode("bands").alias("key")), "near-keys")
    size = stage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-size")
    keys = stage(keys.join(size, "key"), "near-groups")
    # company of a member: how many others it meets, over all bands
    company = stage(keys.groupBy("doc_id").agg(F.sum("n").alias("company")), "near-company")
    hubs = stage(keys.join(company, "doc_id").groupBy("key", "company")
                 .agg(F.min("doc_id").alias("first"))
                 .groupBy("key").agg(F.max_by("first", "company").alias("hub")), "near-hubs")
    members = stage(keys.select("key", "doc_id").join(hubs, "key").filter("doc_id != hub"),
                    "near-grouped")
    star = members.select(F.col("doc_id").alias("a"), F.col("hub").alias("b")).distinct()
    ids = members.select("doc_id").union(members.select("hub")).distinct()
    sigs = stage(own.select("doc_id", "sig").join(ids, "doc_id", "left_semi"), "near-sigs")
    texts = stage(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                              text_or_empty(text_col).cast("binary").alias("text"))
                  .join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "near-texts")
    near = stage(_near(star, sigs, NEAR), "near-star")
    checked = stage(_compared(near, texts), "near-checked")
    first = checked.filter("linked").select("a", "b")
    comp = components(first, "near-cc0")
    # the second stars join most of what the first ones left
    asks, has, own_stars = _meetings(checked)
    again = _second_stars(asks, has)
    for end in ("a", "b"):
        again = _labelled(again, comp, end)
    again = stage(_near(again.filter("comp_a != comp_b").select("a", "b"), sigs, FLOOR), "near-again")
    first = stage(first.unionByName(_compared(again, texts).filter("linked").select("a", "b")), "near-first")
    comp = components(first, "near-cc1")
    pair = [F.col("a").alias("doc_id"), F.col("b").alias("hub")]
    far = stage(members.join(checked.filter("linked").select(*pair), ["doc_id", "hub"], "left_anti")
                .join(near.select(*pair, F.lit(False).alias("far")), ["doc_id", "hub"], "left")
                .select("key", "doc_id", F.coalesce("far", F.lit(True)).alias("far")), "near-left")
    lab = comp.select(F.col("id").alias("a"), F.col("comp").alias("ca"))
    lab2 = comp.select(F.col("id").alias("b"), F.col("comp").alias("cb"))
    more = stage(_by_novel(asks, has, own_stars, comp).unionByName(_by_groups(far, comp, sigs)).distinct()
                 .join(lab, "a", "left").join(lab2, "b", "left")
                 .filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"),
                 "near-more")
    more = stage(_near(more, sigs, FLOOR), "near-close")
    second = stage(_compared(more, texts).filter("linked").select("a", "b"), "near-links")
    if not second.isEmpty():
        # components of components: the first labels stand for their members
        between = (second.join(lab, "a", "left").join(lab2, "b", "left")
                   .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
                   .filter("a != b").distinct())
        top = components(between, "near-cc2").select(F.col("id").alias("comp"),
                                                     F.col("comp").alias("top"))
        # a document that had no first link may be an end of a second one
        ends = second.select(F.col("a").alias("id")).union(second.select("b")).distinct()
        known = comp.join(ends, "id", "full").select("id", F.coalesce("comp", "id").alias("comp"))
        comp = stage(known.join(top, "comp", "left")
                     .select("id", F.coalesce("top", "comp").alias("comp")), "near-comp")
    label = stage(reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left")
                  .select("hi", "lo", F.coalesce("comp", "rep").alias("component_id")), "near-label")
    light = signed.select("doc_id", "n_shingles", "hi", "lo")
    out = light.filter("n_shingles > 0").join(label, ["hi", "lo"], "left")
    alone = light.filter("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return (out.select("doc_id", "n_shingles",
                       F.when(F.col("doc_id").isNotNull(), F.col("component_id"))
                       .alias("component_id"))
            .unionByName(alone.select("doc_id", "n_shingles", "component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
