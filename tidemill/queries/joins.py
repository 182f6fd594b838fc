"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators.joins import cogroup_beside, map_side_join, pair_with_all
from tidemill.plans.bounds import checked_broadcast
from tidemill.plans.skew import join_full_split, join_hot_split, join_salted
from tidemill.queries.aggregates import as_text
from tidemill.registry import query

ORDERS_SQL = """select c.c_custkey, c.c_name, o.o_orderkey, o.o_totalprice
    from customer c join orders o on c.c_custkey = o.o_custkey"""

SUPPLY_SQL = """select l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_extendedprice, s.s_name
    from lineitem l join supplier s on l.l_suppkey = s.s_suppkey"""


def customer_orders(t):
    orders = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice"
    )
    return t.customer.select("c_custkey", "c_name"), orders


def supply_sides(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice")
    return lines, t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), "s_name")


@query("join_inner", ORDERS_SQL)
def join_inner(t):
    customers, orders = customer_orders(t)
    return customers.join(orders, "c_custkey", "inner")


@query(
    "join_name_list",
    """select e.event_id, e.user_id, e.event_type, a.n from events e join
       (select user_id, event_type, count(*) as n from events group by 1, 2) a
       on e.user_id = a.user_id and e.event_type = a.event_type""",
)
def join_name_list(t):
    events = t.events.select("event_id", "user_id", "event_type")
    counts = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return events.join(counts, ["user_id", "event_type"])


@query(
    "join_left",
    """select d.doc_id, d.lang, l.quality, l.toxic from documents d left join labels l
       on d.doc_id = l.doc_id""",
)
def join_left(t):
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left_outer")


@query(
    "join_right",
    """select d.doc_id, d.n_chars, l.quality from labels l right join documents d
       on d.doc_id = l.doc_id""",
)
def join_right(t):
    labels = t.labels.select("doc_id", "quality")
    return labels.join(t.documents.select("doc_id", "n_chars"), "doc_id", "right")


@query(
    "join_full",
    """select coalesce(a.doc_id, b.doc_id) as doc_id, a.lang, b.quality
       from (select doc_id, lang from documents where lang = 'en') a
       full join (select doc_id, quality from labels) b on a.doc_id = b.doc_id""",
)
def join_full(t):
    english = t.documents.filter(F.col("lang") == "en").select("doc_id", "lang")
    return join_full_split(english, t.labels.select("doc_id", "quality"), ["doc_id"])


@query(
    "join_semi",
    """select doc_id, source from documents d
       where exists (select 1 from labels l where l.doc_id = d.doc_id and l.quality = 1)""",
)
def join_semi(t):
    good = t.labels.filter(F.col("quality") == 1).select("doc_id")
    return t.documents.select("doc_id", "source").join(good, "doc_id", "left_semi")


@query(
    "join_anti",
    """select doc_id, source from documents d
       where not exists (select 1 from labels l where l.doc_id = d.doc_id)""",
)
def join_anti(t):
    labelled = t.labels.select("doc_id")
    return t.documents.select("doc_id", "source").join(labelled, "doc_id", "left_anti")


@query(
    "join_cross",
    "select s_suppkey, r_regionkey, r_name from supplier cross join region",
)
def join_cross(t):
    return pair_with_all(t.supplier.select("s_suppkey"), t.region)


@query("join_broadcast", SUPPLY_SQL)
def join_broadcast(t):
    lines, suppliers = supply_sides(t)
    return lines.join(checked_broadcast(suppliers), "l_suppkey")


@query("join_shuffle_hash", SUPPLY_SQL)
def join_shuffle_hash(t):
    lines, suppliers = supply_sides(t)
    return lines.join(suppliers.hint("shuffle_hash"), "l_suppkey")


@query("join_sort_merge", SUPPLY_SQL)
def join_sort_merge(t):
    lines, suppliers = supply_sides(t)
    return lines.join(suppliers.hint("merge"), "l_suppkey")


@query(
    "join_map_side",
    """select l.l_orderkey, l.l_linenumber, l.l_partkey, coalesce(p.p_name, '') as p_name
       from lineitem l left join part p on l.l_partkey = p.p_partkey and p.p_size > 10""",
)
def join_map_side(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    names = t.part.filter(F.col("p_size") > 10).select(
        F.col("p_partkey").alias("l_partkey"), "p_name"
    )
    return map_side_join(lines, names, "l_partkey", "p_name")


@query("join_salted", SUPPLY_SQL)
def salted(t):
    return join_salted(*supply_sides(t), ["l_suppkey"])


@query("join_hot_split", SUPPLY_SQL)
def hot_split(t):
    return join_hot_split(*supply_sides(t), ["l_suppkey"], fraction=0.01)


@query(
    "cogroup",
    """with a as (select key, (rn - 1) // 20 as chunk, list(v order by rn) as left_items from
         (select o_custkey as key, o_orderkey as v,
          row_number() over (partition by o_custkey order by o_orderkey) as rn from orders)
         group by 1, 2),
       b as (select key, (rn - 1) // 20 as chunk, list(v order by rn) as right_items from
         (select user_id as key, event_id as v,
          row_number() over (partition by user_id order by event_id) as rn from events)
         group by 1, 2)
       select coalesce(a.key, b.key) as key, coalesce(a.chunk, b.chunk) as chunk,
         array_to_string(left_items, ',') as left_items,
         array_to_string(right_items, ',') as right_items from a full join b on a.key = b.key and a.chunk = b.chunk""",
)
def cogroup(t):
    orders = t.orders.select(F.col("o_custkey").alias("key"), "o_orderkey")
    events = t.events.select(F.col("user_id").alias("key"), "event_id")
    both = cogroup_beside(orders, events, "key", "o_orderkey", "event_id", chunk_rows=20)
    return both.withColumns({c: as_text(c) for c in ("left_items", "right_items")})


@query(
    "join_chain",
    """select n.n_name, count(*) as orders, round(sum(o.o_totalprice), 2) as total
       from customer c join orders o on c.c_custkey = o.o_custkey
       left join nation n on c.c_nationkey = n.n_nationkey
       where o.o_orderstatus = 'F' group by n.n_name""",
)
def join_chain(t):
    orders = t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey", "o_totalprice")
    return (
        t.customer.select("c_custkey", "c_nationkey")
        .join(orders, F.col("c_custkey") == F.col("o_custkey"))
        .join(
            t.nation.select("n_nationkey", "n_name"),
            F.col("c_nationkey") == F.col("n_nationkey"),
            "left",
        )
        .groupBy("n_name")
        .agg(
            F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
        )
    )
