"""Window functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.plans.ordered import LargeKeys, OrderedKeys
from tidemill.registry import query


def daily(t):
    return t.events.select(
        "event_id", "user_id", F.col("ts").cast("date").alias("day"), "ts", "value"
    )


def ordered(t, *columns):
    events = t.events.select("event_id", "user_id", "ts", *columns)
    return OrderedKeys(events, ["user_id"], ["ts", "event_id"])


@query(
    "win_running_range",
    """select event_id, round(sum(value) over (partition by user_id order by cast(ts as date)), 2)
       as running from events""",
)
def win_running_range(t):
    events = daily(t).select("event_id", "user_id", "day", "value")
    keyed = OrderedKeys(events, ["user_id"], ["day"])
    return keyed.running_range("running", "sum", F.col("value")).select(
        "event_id", F.round("running", 2).alias("running")
    )


@query(
    "win_running_rows",
    """select event_id, round(sum(value) over (partition by user_id order by ts, event_id
       rows between unbounded preceding and current row), 2) as running from events""",
)
def win_running_rows(t):
    return (
        ordered(t, "value")
        .running("running", "sum", F.col("value"))
        .select("event_id", F.round("running", 2).alias("running"))
    )


@query(
    "win_sliding",
    """select event_id, round(sum(value) over (partition by user_id order by ts, event_id
       rows between 1 preceding and 1 following), 2) as near from events""",
)
def win_sliding(t):
    near = {"near": lambda w: F.round(F.sum("value").over(w.rowsBetween(-1, 1)), 2)}
    return ordered(t, "value").framed(near, 1).select("event_id", "near")


@query(
    "win_full",
    """select event_id, round(sum(value) over (partition by user_id order by ts, event_id
       rows between unbounded preceding and unbounded following), 2) as total from events""",
)
def win_full(t):
    return (
        ordered(t, "value")
        .totals("total", F.sum("value"))
        .select("event_id", F.round("total", 2).alias("total"))
    )


@query(
    "win_rank",
    """select event_id, rank() over (partition by user_id order by cast(ts as date)) as rnk,
       dense_rank() over (partition by user_id order by cast(ts as date)) as dense,
       row_number() over (partition by user_id order by ts, event_id) as rn from events""",
)
def win_rank(t):
    events = daily(t).select("event_id", "user_id", "day", "ts")
    large = LargeKeys.measure(events, ["user_id"])
    numbered = OrderedKeys(events, ["user_id"], ["ts", "event_id"], large=large).position("rn")
    return (
        OrderedKeys(numbered, ["user_id"], ["day"], large=large)
        .ranks("rnk", "dense")
        .select("event_id", "rnk", "dense", "rn")
    )


@query(
    "win_lag_lead",
    """select event_id, lag(value, 2) over w as two_before, lead(value, 2) over w as two_after
       from events window w as (partition by user_id order by ts, event_id)""",
)
def win_lag_lead(t):
    columns = {
        "two_before": lambda w: F.lag("value", 2).over(w),
        "two_after": lambda w: F.lag("value", -2).over(w),
    }
    return ordered(t, "value").framed(columns, 2).select("event_id", *columns)


@query(
    "win_sql_text",
    """select user_id, event_id, value from (select user_id, event_id, value, row_number() over
       (partition by user_id order by ts desc, event_id desc) as rn from events) where rn <= 2""",
)
def win_sql_text(t):
    """SQL text with SORT BY; the rank filter is applied before the shuffle as well."""
    return t.spark.sql(
        """SELECT user_id, event_id, value FROM (
             SELECT user_id, event_id, value, row_number() OVER
               (PARTITION BY user_id SORT BY ts DESC, event_id DESC) AS rn FROM {events})
           WHERE rn <= 2""",
        events=t.events,
    )


@query(
    "topn_per_group",
    """select o_custkey, o_orderkey, o_totalprice, rnk from (select o_custkey, o_orderkey,
       o_totalprice, cast(rank() over (partition by o_custkey order by o_totalprice desc)
       as integer) as rnk from orders) where rnk <= 3""",
)
def topn_per_group(t):
    best = Window.partitionBy("o_custkey").orderBy(F.col("o_totalprice").desc())
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return orders.withColumn("rnk", F.rank().over(best)).filter(F.col("rnk") <= 3)
