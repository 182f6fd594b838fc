"""Worked analyses as reusable jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.text import words
from tidemill.plans.bounds import checked_broadcast
from tidemill.plans.ordered import ROWS_PER_TASK, OrderedKeys


def longest_streaks(logins: DataFrame, user: str, day: str, name: str = "cnt_days") -> DataFrame:
    """Longest run of consecutive days per user.

    Repeated days are dropped before the window, so a user has at most one row per
    calendar day there, however many log-ins they have.
    """
    days = logins.select(user, day).distinct()
    number = F.row_number().over(Window.partitionBy(user).orderBy(day))
    runs = days.withColumn("_run", F.date_sub(F.col(day), number))
    lengths = runs.groupBy(user, "_run").agg(F.count(F.lit(1)).alias("_n"))
    return lengths.groupBy(user).agg(F.max("_n").alias(name))


def pivot_sums(df: DataFrame, key: str, column: str, values: list[str], amount: str) -> DataFrame:
    """One column per listed value; 0 where a key has none."""
    return df.groupBy(key).pivot(column, values).agg(F.sum(amount)).na.fill(0, subset=values)


def pivot_when(df: DataFrame, key: str, column: str, values: list[str], amount: str) -> DataFrame:
    """``pivot_sums`` written with conditional sums."""
    return df.groupBy(key).agg(*_conditional_sums(column, values, amount))


def _conditional_sums(column: str, values: list[str], amount: str) -> list[Column]:
    return [
        F.coalesce(F.sum(F.when(F.col(column) == v, F.col(amount))), F.lit(0.0)).alias(v)
        for v in values
    ]


def pivot_with_total(
    df: DataFrame, key: str, column: str, values: list[str], amount: str, label: str = "total"
) -> DataFrame:
    """The pivot with a total per row and one more line for all keys, in one pass. The total
    counts every value, also those without a column."""
    sums = df.rollup(key).agg(
        F.grouping(key).alias("_all"),
        *_conditional_sums(column, values, amount),
        F.coalesce(F.sum(amount), F.lit(0.0)).alias("_sum"),
    )
    name = F.when(F.col("_all") == 1, F.lit(label)).otherwise(F.col(key).cast("string"))
    return sums.select(name.alias(key), *values, F.col("_sum").alias("total"))


def page_and_visitor_counts(visits: DataFrame, visitor: str, day: str) -> DataFrame:
    """Per day: visits, different visitors, and visitors seen for the first time.

    Visits are added up per (visitor, day) first; after that a visitor has at most one
    row per calendar day.
    """
    per_day = visits.groupBy(visitor, day).agg(F.count(F.lit(1)).alias("_n"))
    first = F.min(day).over(Window.partitionBy(visitor))
    return (
        per_day.withColumn("_new", (F.col(day) == first).cast("int"))
        .groupBy(day)
        .agg(
            F.sum("_n").alias("pv"),
            F.count(F.lit(1)).alias("uv"),
            F.sum("_new").alias("new_uv"),
        )
    )


def counts_joined(visits: DataFrame, visitor: str, day: str) -> DataFrame:
    """Visits and visitors per day as two aggregates joined on the day."""
    pv = visits.groupBy(day).agg(F.count(F.lit(1)).alias("pv"))
    uv = visits.select(day, visitor).distinct().groupBy(day).agg(F.count(F.lit(1)).alias("uv"))
    return pv.join(uv, day)


def words_by_key(df: DataFrame, key: str, text: str, separator: str = r"\s+") -> DataFrame:
    return words(df, text, [key], separator).groupBy(key, "word").agg(
        F.count(F.lit(1)).alias("cnt")
    )


def label_tags(lists: DataFrame, tags: str, labels: DataFrame, tag: str, label: str) -> DataFrame:
    """Each different tag list with the sorted labels of its tags; unknown tags are left out."""
    cells = lists.select(tags).distinct()
    pairs = cells.select(tags, F.explode(F.split(tags, ",")).alias(tag)).distinct()
    named = pairs.join(checked_broadcast(labels), tag).groupBy(tags)
    return named.agg(F.concat_ws(",", F.sort_array(F.collect_set(label))).alias("labels"))


def peaks_and_troughs(
    ticks: DataFrame,
    keys: list[str],
    order: list[str],
    price: str,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Ticks strictly above or below both neighbours; the first and last of a key are neither."""
    near = OrderedKeys(ticks, keys, order, rows_per_task).framed(
        {
            "_before": lambda w: F.lag(price).over(w),
            "_after": lambda w: F.lead(price).over(w),
        },
        1,
    )
    value, before, after = F.col(price), F.col("_before"), F.col("_after")
    kind = F.when((value > before) & (value > after), "peak").when(
        (value < before) & (value < after), "trough"
    )
    return (
        near.withColumn("kind", kind)
        .filter(F.col("kind").isNotNull())
        .drop("_before", "_after")
    )


def dashboard_slots(
    amounts: DataFrame, moment: str, amount: str, slide: str = "5 seconds", panes: int = 2
) -> DataFrame:
    """Per slide: sum and whole mean; per ``panes`` slides, every slide: sum. One row per
    metric and slot. Slots are added up once and the longer windows are made from them.
    """
    slots = amounts.groupBy(F.window(moment, slide)["start"].alias("slot")).agg(
        F.sum(amount).alias("s"), F.count(F.lit(1)).alias("n")
    )
    return slot_metrics(slots, slide, panes)


def slot_metrics(slots: DataFrame, slide: str = "5 seconds", panes: int = 2) -> DataFrame:
    """The metrics of ``dashboard_slots`` from sums ``s`` and counts ``n`` per ``slot``."""
    names = ["sumMoney5", "avgMoney5"]  # fixed values: metric names
    values = [F.col("s"), F.expr("s div n")]
    short = slots.select(
        "slot",
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("event"), v.alias("value"))
                      for n, v in zip(names, values)])
        ).alias("m"),
    ).select("m.event", "slot", "m.value")
    step = F.expr(f"INTERVAL {slide}")
    starts = F.array(*[F.col("slot") - step * i for i in range(panes)])
    wide = slots.select(F.explode(starts).alias("slot"), "s").groupBy("slot").agg(
        F.sum("s").alias("value")
    )
    return short.unionByName(wide.select(F.lit("sumMoneyWin10").alias("event"), "slot", "value"))


def visitor_sets(visits: DataFrame, user: str, day: str) -> DataFrame:
    """Who came on each day, to be stored: ``day, bucket, visitors``, a bitmap per 32,768 ids of
    ``user`` (whole numbers). A repeated visit sets a bit that is set; sets are merged by OR, so
    any span of days is counted from them without the visits."""
    known = visits.where(F.col(user).isNotNull() & F.col(day).isNotNull())
    bucket = F.bitmap_bucket_number(F.col(user)).alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(F.col(user))).alias("visitors")
    return known.groupBy(F.col(day).alias("day"), bucket).agg(bits)


def visitors_per(sets: DataFrame, period: Column) -> DataFrame:
    """Different visitors per period, from the stored sets."""
    merged = sets.groupBy(period.alias("period"), "bucket").agg(F.bitmap_or_agg("visitors").alias("v"))
    return merged.groupBy("period").agg(F.sum(F.bitmap_count("v")).alias("visitors"))
