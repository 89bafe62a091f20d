"""Order inside a day without one task a day: rows dealt to time ranges, with some rows of the neighbouring ranges (a halo) beside them.

A day is cut into ranges of about ``ROWS_PER_RANGE`` rows. The cuts come from exact counts of time buckets, not from a sample;
consecutive buckets share a range until it is full, and a bucket with more rows than that is cut into equal shares of its time.
What looks at a fixed number of neighbours (frames, trailing statistics, smoothing, gaps) runs over a range and its halo as if these were
a small day; afterwards only the range's own rows stay. Positions and running sums are a range's own plus an offset, the total of the
ranges before it. So a day of any length is as many tasks as it has ranges.

What ranges need to know of each other is one row a range (first and last rows, totals), in windows by day. Rows of one millisecond stay
in one range, which is the finest cut.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

DAY = "day_id"
RANGE = "range_no"
OWN = "range_own"
#: Partition columns of windows over ranges.
KEYS = (DAY, RANGE)
ROWS_PER_RANGE = 200_000
#: Width of the buckets whose rows are counted (milliseconds of a time, or steps of an index).
BUCKET = 60_000
#: Numbers kept for the shares of one heavy bucket.
SHARES = 1 << 20


def over(keys: Sequence[str], order: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def in_range(order: Sequence[str]) -> WindowSpec:
    """Windows over a range and its halo."""
    return over(KEYS, order)


def with_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df with range_no, which rises with the order inside a day. order begins with a whole number (a time in milliseconds, an index);
    rows without one come first. A df that has ranges keeps them."""
    if RANGE in df.columns:
        return df
    value = F.coalesce(F.col(order[0]).cast("long"), F.lit(-(1 << 52)))
    bucket = F.floor(value / BUCKET)
    counts = df.groupBy(DAY, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_m"))
    before = F.coalesce(F.sum("_m").over(over([DAY], ["_bucket"]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shares = F.least(F.ceil(F.col("_m") / ROWS_PER_RANGE), F.lit(SHARES).cast("long"))
    # a light bucket belongs to the range in which its first row falls; a heavy one has ranges of its own after that one
    first = F.floor(before / ROWS_PER_RANGE) * 2 + (shares > 1).cast("long")
    plan = counts.select(F.col(DAY).alias("_day"), "_bucket", shares.alias("_shares"), (first * SHARES).alias("_first"))
    joined = df.withColumn("_at", bucket).join(plan, F.col(DAY).eqNullSafe(F.col("_day")) & (F.col("_at") == F.col("_bucket")))
    inside = F.floor(F.pmod(value, F.lit(BUCKET)) * F.col("_shares") / BUCKET)
    return joined.withColumn(RANGE, (F.col("_first") + inside).cast("long")).drop("_day", "_at", "_bucket", "_shares", "_first")


def with_halo(ranged: DataFrame, order: Sequence[str], before: int, after: int) -> DataFrame:
    """ranged with range_own (true), and copies (false) of rows before and after each range of its day: the last ``before`` rows of each
    of as many ranges before it, and the first ``after`` of as many after it. Each range holds a row at least, so what lies within that
    reach of its own rows is among them."""
    names = [c for c in ranged.columns if c not in KEYS]
    whole = ranged.withColumn(OWN, F.lit(True)).select(*KEYS, *names, OWN)
    if not before and not after:
        return whole
    numbered = ranged.withColumns({"_i": F.row_number().over(in_range(order)), "_n": F.count(F.lit(1)).over(Window.partitionBy(*KEYS))})
    head, tail = F.col("_i") <= after, F.col("_i") > F.col("_n") - before
    row = F.struct(*names)
    lists = numbered.where(head | tail).groupBy(*KEYS).agg(F.collect_list(F.when(head, row)).alias("_head"), F.collect_list(F.when(tail, row)).alias("_tail"))
    days = over([DAY], [RANGE])
    lent = [F.flatten(F.collect_list(c).over(days.rowsBetween(*reach))) for c, reach, n in (("_tail", (-before, -1), before), ("_head", (1, after), after)) if n]
    halo = lists.select(*KEYS, F.concat(*lent).alias("_rows")).select(*KEYS, F.explode("_rows").alias("_r"))
    return whole.union(halo.select(*KEYS, *(F.col("_r").getField(c).alias(c) for c in names), F.lit(False)))


def own_rows(df: DataFrame) -> DataFrame:
    """The rows that are a range's own, without the columns of ranges."""
    return df.where(OWN).drop(RANGE, OWN)


def neighbourhood(df: DataFrame, order: Sequence[str], before: int, after: int) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """df by ranges with a halo, and what brings a result back to its own rows. Where df already has a halo (several operators in a row
    share one that is wide enough for all), both are left to the caller."""
    if OWN in df.columns:
        return df, lambda out: out
    return with_halo(with_ranges(df, order), order, before, after), own_rows


def running(ranged: DataFrame, order: Sequence[str], value: Column, name: str) -> DataFrame:
    """ranged (without a halo) with the running sum of value over the day, its own row included."""
    marked = ranged.withColumn("_v", value)
    totals = marked.groupBy(*KEYS).agg(F.sum("_v").alias("_t"))
    before = F.coalesce(F.sum("_t").over(over([DAY], [RANGE]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = totals.select(F.col(DAY).alias("_day"), F.col(RANGE).alias("_range"), before.alias("_o"))
    own = marked.withColumn(name, F.sum("_v").over(in_range(order).rowsBetween(Window.unboundedPreceding, 0)))
    out = own.join(starts, F.col(DAY).eqNullSafe(F.col("_day")) & (F.col(RANGE) == F.col("_range")))
    return out.withColumn(name, F.col(name) + F.col("_o")).drop("_v", "_day", "_range", "_o")
