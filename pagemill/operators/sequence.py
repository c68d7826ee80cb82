"""Running sums and row numbers without one task per group.

A window ``partitionBy(key).orderBy(...)`` sends a whole group to one task,
and a window without ``partitionBy`` sends the whole table to one task.  Both
break when a key holds a third of the rows.  Here the order is cut into
buckets by a caller-supplied BIGINT column that never decreases along the
order (for example ``pos >> 10`` or hours since the epoch):

1. one shuffle on (key, bucket) carries the rows; each task holds whole
   buckets, so a task's size is bounded by the bucket width, not the key;
2. bucket totals (one row per bucket) get an exclusive running sum in two
   levels: within a super-bucket of 1024 buckets, then over super-buckets --
   small windows at both levels, even for a global order;
3. a local window per (key, bucket) adds the running sum inside the bucket;
4. an equi-join on (key, bucket) with the small bucket-base table.  The big
   side is already hash-partitioned on those columns, so only the small side
   moves; AQE turns the join into a broadcast when it is small at run time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Positions per bucket (2^10) and buckets per super-bucket (2^10).
POS_BUCKET_BITS = 10
SUPER_BITS = 10


def pos_bucket(pos: Column | str, bits: int = POS_BUCKET_BITS) -> Column:
    return F.shiftright(F.col(pos) if isinstance(pos, str) else pos, bits)


def hour_bucket(ts: Column | str) -> Column:
    """Hours since the epoch, for orders that start with a timestamp."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(c.cast("timestamp")) / 3_600_000_000).cast("long")


def _exclusive(total: str, by: list[str], order: str) -> Column:
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(order)
    return F.coalesce(F.sum(total).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def prefix_sum(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
               bucket: Column, value: Column | None = None, name: str = "offset",
               inclusive: bool = False) -> DataFrame:
    """Add ``name`` = sum of ``value`` over the rows before this one.

    Rows are ordered by ``order`` within each group of ``by`` (``by`` may be
    empty for one global order).  ``bucket`` must be a BIGINT that never
    decreases along the order.  With ``inclusive`` the row's own value is
    included.  ``value`` defaults to 1, which makes ``inclusive`` a row
    number.
    """
    by = list(by)
    val = F.lit(1).cast("long") if value is None else value.cast("long")
    work = (df.withColumn("_pm_b", bucket.cast("long")).withColumn("_pm_v", val)
            .repartition(*by, "_pm_b"))

    totals = (work.groupBy(*by, "_pm_b").agg(F.sum("_pm_v").alias("_pm_t"))
              .withColumn("_pm_sb", F.shiftright("_pm_b", SUPER_BITS)))
    in_super = totals.select(*by, "_pm_b", "_pm_sb",
                             _exclusive("_pm_t", by + ["_pm_sb"], "_pm_b").alias("_pm_in"))
    supers = (totals.groupBy(*by, "_pm_sb").agg(F.sum("_pm_t").alias("_pm_st"))
              .select(*by, "_pm_sb", _exclusive("_pm_st", by, "_pm_sb").alias("_pm_sup")))
    base = (in_super.join(supers, [*by, "_pm_sb"])
            .select(*by, "_pm_b", (F.col("_pm_sup") + F.col("_pm_in")).alias("_pm_base")))

    wl = Window.partitionBy(*by, "_pm_b").orderBy(*order)
    frame = wl.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = work.withColumn(
        "_pm_local", F.coalesce(F.sum("_pm_v").over(frame), F.lit(0)))

    return (local.join(base, on=[*by, "_pm_b"], how="inner")
            .withColumn(name, F.col("_pm_base") + F.col("_pm_local"))
            .drop("_pm_b", "_pm_v", "_pm_base", "_pm_local"))


def row_number(df: DataFrame, by: Sequence[str], order: Sequence[str | Column],
               bucket: Column, name: str = "rn") -> DataFrame:
    """1-based row number per group of ``by`` in ``order``, bucketed as above."""
    return prefix_sum(df, by, order, bucket, None, name, inclusive=True)
