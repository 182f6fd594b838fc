"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.text import words
from tidemill.operators.aggregates import (
    first_per_key,
    integer_mean,
    item_sets,
    observed,
    two_level,
)
from tidemill.plans.ordered import collect_chunks
from tidemill.plans.skew import agg_salted
from tidemill.registry import query


def as_text(array):
    """An array as text, so that results compare the same everywhere."""
    return F.array_join(F.col(array).cast("array<string>"), ",")


def rows():
    return F.count(F.lit(1))


@query("agg_count", "select o_orderstatus, count(*) as cnt from orders group by 1")
def agg_count(t):
    return t.orders.groupBy("o_orderstatus").agg(rows().alias("cnt"))


@query(
    "agg_sum_count",
    """select o_custkey, round(sum(o_totalprice), 2) as total, count(o_orderkey) as orders
       from orders group by 1""",
)
def agg_sum_count(t):
    return t.orders.groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("o_orderkey").alias("orders")
    )


@query(
    "agg_stats",
    """select l_returnflag, count(l_quantity) as n, round(avg(l_quantity), 6) as mean,
       round(stddev_samp(l_quantity), 6) as deviation, min(l_quantity) as low,
       max(l_quantity) as high from lineitem group by 1""",
)
def agg_stats(t):
    q = "l_quantity"
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count(q).alias("n"),
        F.round(F.avg(q), 6).alias("mean"),
        F.round(F.stddev_samp(q), 6).alias("deviation"),
        F.min(q).alias("low"),
        F.max(q).alias("high"),
    )


@query("agg_global_sum", "select round(sum(value), 2) as total from events")
def agg_global_sum(t):
    return t.events.agg(F.round(F.sum("value"), 2).alias("total"))


@query(
    "agg_int_avg",
    """select event_type, cast(sum(cast(trunc(value) as bigint)) // count(*) as bigint) as mean
       from events group by 1""",
)
def agg_int_avg(t):
    amounts = t.events.select("event_type", F.col("value").cast("bigint").alias("amount"))
    return amounts.groupBy("event_type").agg(integer_mean("amount").alias("mean"))


@query(
    "agg_mae",
    """select round(avg(abs(l_extendedprice - 2000 * l_quantity)), 4) as mean_error
       from lineitem""",
)
def agg_mae(t):
    error = F.abs(F.col("l_extendedprice") - 2000 * F.col("l_quantity"))
    return t.lineitem.agg(F.round(F.avg(error), 4).alias("mean_error"))


WORD_COUNT_SQL = r"""select word, count(*) as cnt from
    (select unnest(regexp_split_to_array(text, '\s+')) as word from documents)
    where word <> '' group by word"""


@query("word_count", WORD_COUNT_SQL)
def word_count(t):
    return words(t.documents, "text").groupBy("word").agg(rows().alias("cnt"))


@query(
    "agg_collect_list",
    """select o_custkey, (rn - 1) // 100000 as chunk,
       array_to_string(list(o_orderkey order by rn), ',') as items from
       (select o_custkey, o_orderkey, row_number() over (partition by o_custkey
        order by o_orderkey) as rn from orders) group by 1, 2""",
)
def agg_collect_list(t):
    orders = t.orders.select("o_custkey", "o_orderkey")
    chunks = collect_chunks(orders, ["o_custkey"], ["o_orderkey"], "o_orderkey")
    return chunks.withColumn("items", as_text("items"))


@query(
    "agg_two_level",
    """select l_suppkey, sum(v) as v from (select l_suppkey, l_orderkey % 4 as part,
       max(l_quantity) as v from lineitem group by 1, 2) group by 1""",
)
def agg_two_level(t):
    lines = t.lineitem.select(
        "l_suppkey", "l_quantity", (F.col("l_orderkey") % 4).alias("part")
    )
    return two_level(lines, ["l_suppkey"], "part", F.max, F.sum, "l_quantity", "v")


@query(
    "agg_fold",
    "select l_suppkey, sum(l_linenumber)::bigint as folded from lineitem group by 1",
)
def agg_fold(t):
    return t.lineitem.groupBy("l_suppkey").agg(F.sum("l_linenumber").alias("folded"))


@query("agg_count_by_value", "select l_quantity as value, count(*) as cnt from lineitem group by 1")
def agg_count_by_value(t):
    return t.lineitem.groupBy(F.col("l_quantity").alias("value")).agg(rows().alias("cnt"))


@query("distinct_rows", "select distinct o_custkey, o_orderstatus from orders")
def distinct_rows(t):
    return t.orders.select("o_custkey", "o_orderstatus").distinct()


@query(
    "dedup_cols",
    """select o_custkey, o_orderpriority, min(o_orderdate) as o_orderdate,
       arg_min(o_orderkey, (o_orderdate, o_orderkey)) as o_orderkey from orders group by 1, 2""",
)
def dedup_cols(t):
    orders = t.orders.select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    return first_per_key(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query(
    "agg_baskets",
    """select user_id, array_to_string(list(distinct event_type order by event_type), '+') as items
       from events group by 1""",
)
def agg_baskets(t):
    sets = item_sets(t.events, "user_id", "event_type")
    return sets.withColumn("items", F.array_join("items", "+"))


@query(
    "agg_concat",
    """select user_id, string_agg(distinct event_type, ',' order by event_type) as tags
       from events group by 1""",
)
def agg_concat(t):
    sets = item_sets(t.events, "user_id", "event_type")
    return sets.select("user_id", F.concat_ws(",", "items").alias("tags"))


GROUPED_SQL = """select l_returnflag, l_linestatus, cast(grouping(l_returnflag) as integer) as g1,
    cast(grouping(l_linestatus) as integer) as g2, count(*) as cnt, sum(l_quantity) as quantity
    from lineitem group by {}(l_returnflag, l_linestatus)"""


def grouped_measures():
    return [
        F.grouping("l_returnflag").cast("int").alias("g1"),
        F.grouping("l_linestatus").cast("int").alias("g2"),
        rows().alias("cnt"),
        F.sum("l_quantity").alias("quantity"),
    ]


@query("agg_cube", GROUPED_SQL.format("cube"))
def agg_cube(t):
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(*grouped_measures())


@query("agg_rollup", GROUPED_SQL.format("rollup"))
def agg_rollup(t):
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(*grouped_measures())


@query(
    "agg_salted",
    """select l_returnflag, count(*) as cnt, sum(l_quantity) as quantity,
       round(avg(l_quantity), 6) as mean, min(l_shipdate) as first_day,
       max(l_shipdate) as last_day from lineitem group by 1""",
)
def salted(t):
    aggregates = {
        "cnt": ("count", F.lit(1)),
        "quantity": ("sum", F.col("l_quantity")),
        "mean": ("avg", F.col("l_quantity")),
        "first_day": ("min", F.col("l_shipdate")),
        "last_day": ("max", F.col("l_shipdate")),
    }
    return agg_salted(t.lineitem, ["l_returnflag"], aggregates).withColumn(
        "mean", F.round("mean", 6)
    )


@query(
    "observe_metrics",
    """select count(*) as row_total, count(*) filter (where value > 100) as large,
       max(value) as highest from events""",
)
def observe_metrics(t):
    watched, seen = observed(
        t.events.select("value"),
        row_total=rows(),
        large=F.count_if(F.col("value") > 100),
        highest=F.max("value"),
    )
    watched.write.format("noop").mode("overwrite").save()
    return t.spark.createDataFrame([seen.get], "row_total bigint, large bigint, highest double")
