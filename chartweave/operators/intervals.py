"""Merging of overlapping day intervals per entity, and the gaps between them.

Method: the starts and the ends of an entity are ranked independently of each other; the
next-ranked start lying beyond the current-ranked end marks a gap, and the boundaries between
two gaps pair up to a period.  Ranks are kept as cumulative counts over the *distinct* boundary
days of the entity, which a map-side combinable aggregate makes first: a hot entity never has
more rows than there are days, however many intervals it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


#: Days beyond this one are counted as this one when overlaps are counted.
LAST_DAY = "2200-12-31"


def day_of(text: Column) -> Column:
    """The day that a text starts with (``YYYY-MM-DD``, any time of day after it is ignored), else null."""
    t = F.trim(text)
    return F.when(
        t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}($|[T ])"), F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd")
    )


def folded_name(text: Column) -> Column:
    """Upper case, trimmed, runs of blanks reduced to one."""
    return F.trim(F.regexp_replace(F.upper(text), r"\s+", " "))


def periods_and_gaps(df: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """``(*keys, kind, first_day, last_day)``; kind is ``period`` or ``gap``, days are dates, both ends included.

    ``start`` and ``end`` name date columns.  Intervals that overlap, nest, repeat or adjoin (the next
    starts at the latest the day after) form one period.  Rows with a null key, a null day or
    start > end are no intervals.  Empty input gives an empty result; other columns are ignored.
    """
    ok = F.col(start) <= F.col(end)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    at = F.struct(F.col(start).alias("day"), F.lit(1).alias("s"), F.lit(0).alias("e"))
    to = F.struct(F.col(end).alias("day"), F.lit(0).alias("s"), F.lit(1).alias("e"))
    bounds = (
        df.where(ok)
        .select(*keys, F.explode(F.array(at, to)).alias("__b"))
        .groupBy(*keys, F.col("__b.day").alias("__day"))
        .agg(F.sum("__b.s").alias("__s"), F.sum("__b.e").alias("__e"))
    )
    w = W.partitionBy(*keys).orderBy("__day")
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    next_day = F.lead("__day").over(w)
    ranked = bounds.select(
        *keys,
        "__day",
        F.sum("__s").over(so_far).alias("__started"),
        F.sum("__e").over(so_far).alias("__ended"),
        next_day.alias("__next"),
    )
    closes = (F.col("__started") == F.col("__ended")) & (
        F.col("__next").isNull() | (F.col("__next") > F.date_add("__day", 1))
    )
    marked = ranked.withColumn("__closes", closes)
    opens = F.coalesce(F.lag("__closes").over(w), F.lit(True))
    marked = marked.withColumn("__opens", opens).withColumn(
        "__first", F.last(F.when(F.col("__opens"), F.col("__day")), ignorenulls=True).over(so_far)
    )
    period = F.struct(F.lit("period").alias("kind"), F.col("__first").alias("a"), F.col("__day").alias("b"))
    gap = F.struct(
        F.lit("gap").alias("kind"), F.date_add("__day", 1).alias("a"), F.date_sub("__next", 1).alias("b")
    )
    return (
        marked.where("__closes")
        .select(*keys, F.explode(F.when(F.col("__next").isNull(), F.array(period)).otherwise(F.array(period, gap))).alias("__x"))
        .select(*keys, F.col("__x.kind").alias("kind"), F.col("__x.a").alias("first_day"), F.col("__x.b").alias("last_day"))
    )


def overlap_counts(df: DataFrame, others: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """``(*df, overlapping)``: with how many intervals of the other table each one shares a day (itself, by its key, left out).

    An interval overlaps all but those that end before it begins and those that begin after it ends, so two ranks among the
    sorted boundary days tell the number: counts by day are summed and ranked, and no pair of intervals is ever made.
    """
    days = others.where(F.col(first) <= F.col(last))
    events = lambda c, name: days.groupBy(F.col(c).alias("__day")).agg(F.count("*").alias(name))
    starts, ends = _so_far(events(first, "__n"), "__started"), _so_far(events(last, "__n"), "__ended")
    return _count_before(_count_before(df, ends, F.date_sub(first, 1), "__ended"), starts, F.col(last), "__started").join(
        days.select(F.col(key), F.lit(1).alias("__own")).distinct(), key, "left"
    ).withColumn("overlapping", F.col("__started") - F.col("__ended") - F.coalesce("__own", F.lit(0))).drop("__started", "__ended", "__own")


def _so_far(counts: DataFrame, name: str) -> DataFrame:
    """``(from_day, to_day, name)``: the running total of daily counts, for every stretch between two days that have one.  There
    are no more rows than days in the calendar."""
    w = W.orderBy("__day")
    total = F.sum("__n").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))
    return counts.select(F.col("__day").alias("__from"), F.lead("__day").over(w).alias("__to"), total.alias(name))


def _count_before(df: DataFrame, steps: DataFrame, day: Column, name: str) -> DataFrame:
    """The running total on a day, 0 before the first; exploded by day, so that it is an equi-join."""
    table = steps.select(F.explode(F.sequence(F.col("__from"), F.coalesce(F.date_sub("__to", 1), F.greatest("__from", F.lit(LAST_DAY).cast("date"))))).alias("__at"), name)
    return df.withColumn("__at", F.least(day, F.lit(LAST_DAY).cast("date"))).join(table, "__at", "left").withColumn(name, F.coalesce(name, F.lit(0))).drop("__at")


def order_periods(orders: DataFrame) -> DataFrame:
    """``(patient_id, medication, kind, first_day, last_day)``, all text, of an orders table."""
    days = orders.select(
        "patient_id",
        F.nullif(folded_name(F.col("medication")), F.lit("")).alias("medication"),
        day_of(F.col("start_date")).alias("__start"),
        day_of(F.col("end_date")).alias("__end"),
    )
    out = periods_and_gaps(days, ["patient_id", "medication"], "__start", "__end")
    return out.select(
        "patient_id", "medication", "kind", F.col("first_day").cast("string").alias("first_day"), F.col("last_day").cast("string").alias("last_day")
    )
