"""Fetch bookkeeping (FB1-FB6) over a table of fetch attempts.

The network fetch itself is not rebuilt.  Its results are rows
``attempts(link, round, attempt, ts, error, payload)``: ``error`` is NULL on
success and ``payload`` then holds the fetched article fields.  The crawler
retries a link up to ``attempts_per_round`` times per round and runs up to
``max_rounds`` rounds, each only over links still failing, so the outcome is
a closed form: the first success in (round, attempt) order within the
budget, else the last error.  Folds are hash aggregates over light columns with map-side
partial aggregation, so a link with a third of all attempts is pre-reduced in
every task before the shuffle; the payload of the deciding attempt joins last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The crawler's retry budget (rounds, attempts per round).
MAX_ROUNDS = 5
ATTEMPTS_PER_ROUND = 3


def within_budget(attempts: DataFrame, max_rounds: int = MAX_ROUNDS,
                  attempts_per_round: int = ATTEMPTS_PER_ROUND) -> DataFrame:
    return attempts.filter((F.col("round") <= max_rounds) &
                           (F.col("attempt") <= attempts_per_round))


def _winners(inside: DataFrame, by: list[str]) -> DataFrame:
    """The row of each group that decides it: the first success, else the last
    attempt.  ``inside`` has the order ``_at`` as one BIGINT, so the fold is a
    hash aggregate over light columns; payloads join by (group, slot), which no
    hot link can skew.  A slot that was recorded twice gives one row; attempts
    without a link are left out."""
    ok = F.col("error").isNull()
    light = inside.groupBy(*by).agg(F.min(F.when(ok, F.col("_at"))).alias("_win"),
                                    F.max("_at").alias("_last"))
    chosen = light.select(*by, F.coalesce("_win", "_last").alias("_at"),
                          F.col("_win").isNotNull().alias("ok"))
    return (inside.join(chosen, [*by, "_at"]).filter(ok == F.col("ok"))
            .dropDuplicates([*by, "_at"])
            .withColumn("payload", F.when(F.col("ok"), F.col("payload"))))


def attempt_fold(attempts: DataFrame, max_rounds: int = MAX_ROUNDS,
                 attempts_per_round: int = ATTEMPTS_PER_ROUND) -> DataFrame:
    """FB2: one row per (link, round): first success wins, else last error."""
    inside = (within_budget(attempts, max_rounds, attempts_per_round)
              .withColumn("_at", F.col("attempt").cast("long")))
    return _winners(inside, ["link", "round"]).select(
        "link", "round", "ok", F.col("attempt").alias("attempts"), "payload", "error")


def round_fold(attempts: DataFrame, max_rounds: int = MAX_ROUNDS,
               attempts_per_round: int = ATTEMPTS_PER_ROUND) -> DataFrame:
    """FB4: one row per link.  Attempts after the first success are ignored;
    ``rounds`` is the number of rounds the link took part in."""
    inside = (within_budget(attempts, max_rounds, attempts_per_round)
              .withColumn("_at", F.shiftleft(F.col("round").cast("long"), 32) + F.col("attempt")))
    return _winners(inside, ["link"]).select(
        "link", "ok", F.col("round").alias("rounds"), "payload", "error")


def load_dataset(records: DataFrame) -> DataFrame:
    """IO4: keyed dataset; drops rows without a link; for a repeated link the
    last record's values are kept at the first record's position (``pos`` is
    unique).  The fold reads links and positions only."""
    cols = [c for c in records.columns if c not in ("pos", "link")]
    known = records.filter(F.col("link").isNotNull())
    light = known.groupBy("link").agg(F.min("pos").alias("_first"), F.max("pos").alias("pos"))
    return known.join(light, ["link", "pos"]).select(F.col("_first").alias("pos"), "link", *cols)


def needs_fetch(links: DataFrame, dataset: DataFrame) -> DataFrame:
    """FB1: links absent from the dataset, or present with an ``_error`` key
    (key presence, not truthiness); link-list order kept."""
    d = dataset.select("link", F.lit(True).alias("_known"),
                       F.col("error").isNotNull().alias("_failed"))
    return (links.join(d, "link", "left")
            .filter(F.col("_known").isNull() | F.col("_failed"))
            .select("pos", "link"))


def upsert(dataset: DataFrame, fetched: DataFrame, links: DataFrame) -> DataFrame:
    """FB3: dataset after a run.

    ``fetched`` is :func:`round_fold` output for the links of
    :func:`needs_fetch`.  A success replaces the whole record by the payload
    (fields that it lacks become null), a failure by ``{link, _error}``.  Known
    links keep their position; new links follow in link-list order.  Fields
    are those of the dataset, then those only the payload has.
    """
    known = {f.name: f.dataType for f in dataset.schema.fields
             if f.name not in ("pos", "link", "error")}
    payload = {f.name: f.dataType for f in fetched.schema["payload"].dataType.fields}
    fields = {**payload, **known}
    names = [*known, *[c for c in payload if c not in known]]
    ordered = links.select(F.col("pos").alias("_lpos"), "link")
    res = fetched.join(ordered, "link", "left").select(
        "link", "_lpos", F.lit(True).alias("_hit"), F.col("ok").alias("_ok"),
        F.col("error").alias("_err"),
        *[(F.col(f"payload.{c}") if c in payload else F.lit(None)).cast(fields[c]).alias(f"_new_{c}")
          for c in names])
    max_pos = dataset.select(F.coalesce(F.max("pos"), F.lit(-1))).scalar()
    j = dataset.select("pos", "link", "error", *known).join(res, "link", "full")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    old = lambda c: F.when(~hit, F.col(c)) if c in known else F.lit(None)
    return j.select(
        F.coalesce(F.col("pos"), max_pos + 1 + F.col("_lpos")).alias("pos"),
        "link",
        *[F.when(hit & F.col("_ok"), F.col(f"_new_{c}")).otherwise(old(c)).alias(c) for c in names],
        F.when(hit & F.col("_ok"), F.lit(None).cast("string"))
        .when(hit, F.coalesce(F.col("_err"), F.lit(""))).otherwise(F.col("error")).alias("error"))


def failed_links(dataset: DataFrame) -> DataFrame:
    """FB5: every record of the dataset carrying an ``_error`` key."""
    return dataset.filter(F.col("error").isNotNull()).select("pos", "link", "error")


def fetch_report(dataset: DataFrame) -> DataFrame:
    """FB6: total, successful, failed."""
    failed = F.count_if(F.col("error").isNotNull())
    return dataset.agg(F.count(F.lit(1)).alias("total"),
                       (F.count(F.lit(1)) - failed).alias("successful"),
                       failed.alias("failed"))
