"""User-defined functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import aggregators, userdefined
from tidemill.plans.points import LEVELS_SQL
from tidemill.registry import query


@query(
    "udf_sql",
    "select c_custkey, substring(c_mktsegment, 1, 2) as head from customer",
)
def udf_sql(t):
    userdefined.register(t.spark)
    return t.spark.sql(
        "SELECT c_custkey, first_two(c_mktsegment) AS head FROM {customer}", customer=t.customer
    )


@query(
    "udf_dsl",
    f"select o_orderkey, {LEVELS_SQL.format('o_totalprice / 25')} as level from orders",
)
def udf_dsl(t):
    level = userdefined.level_name(F.col("o_totalprice") / 25)
    return t.orders.select("o_orderkey", level.alias("level"))


@query(
    "udaf_yoy",
    """select o_orderpriority, round((sum(o_totalprice) filter (where year(o_orderdate) = 1997) -
       sum(o_totalprice) filter (where year(o_orderdate) = 1996)) /
       sum(o_totalprice) filter (where year(o_orderdate) = 1996), 6) as growth
       from orders group by 1""",
)
def udaf_yoy(t):
    grown = userdefined.growth(F.year("o_orderdate"), "o_totalprice", 1996, 1997)
    return t.orders.groupBy("o_orderpriority").agg(F.round(grown, 6).alias("growth"))


@query("map_partitions", "select event_type, count(*) as cnt from events group by 1")
def map_partitions(t):
    return userdefined.count_by_batches(t.events, "event_type")


@query(
    "udtf_words",
    """select p_partkey, word, cast(count(*) as integer) as cnt from
       (select p_partkey, unnest(string_split(p_name, ' ')) as word from part) group by 1, 2""",
)
def udtf_words(t):
    userdefined.register(t.spark)
    cells = t.part.select("p_partkey", F.translate("p_name", " ", "|").alias("cell"))
    return t.spark.sql(
        "SELECT p_partkey, word, cnt FROM {cells}, LATERAL words_of_cell(cell)", cells=cells
    )


@query(
    "udaf_top_distinct",
    """select l_returnflag, min(l_extendedprice) as least, count(*) as rows from
       (select *, dense_rank() over (partition by l_returnflag order by l_extendedprice desc) as d
        from lineitem where l_extendedprice is not null) where d <= 20 group by 1""",
)
def udaf_top_distinct(t):
    """A user aggregate whose state is no built-in's: one flag holds half of all rows, and no
    task has more than a few states of it."""
    top = aggregators.TopDistinct("l_extendedprice", 20)
    lines = t.lineitem.select("l_returnflag", "l_extendedprice")
    return aggregators.aggregate(lines, ["l_returnflag"], top, "least double, rows bigint")


@query(
    "udtf_table",
    """with cuts as (select *, lag(event_type) over w is distinct from event_type as new
         from events window w as (partition by user_id order by ts, event_id)),
       runs as (select *, sum(new::int) over (partition by user_id order by ts, event_id
         rows unbounded preceding) as run from cuts)
       select user_id, cast(run as integer) as run, event_type, cast(count(*) as integer) as cnt
       from runs group by all""",
)
def udtf_table(t):
    """A table function over partitions of a table, in order: runs of equal events of a user."""
    userdefined.register(t.spark)
    return t.spark.sql(
        """SELECT user_id, run, event_type, cnt FROM runs_of(TABLE(SELECT user_id, event_type, ts,
             event_id FROM {events}) PARTITION BY user_id ORDER BY (ts, event_id),
             'user_id', 'event_type', 5000000)""",
        events=t.events,
    )
