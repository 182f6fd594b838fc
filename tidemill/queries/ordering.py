"""Sort, limit, sample and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators.joins import common_rows, except_rows
from tidemill.operators.ordering import listed_order, zip_with_index
from tidemill.operators.sampling import cut_point, hash_draws, hash_fraction, hash_split, hash_take
from tidemill.registry import query

# fixed values: the order of the priorities
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "sort_multi",
    """select o_orderkey, o_custkey, o_totalprice from orders
       order by o_custkey, o_totalprice desc, o_orderkey""",
)
def sort_multi(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return orders.orderBy(F.col("o_custkey").asc(), F.col("o_totalprice").desc(), "o_orderkey")


@query(
    "sort_negated",
    "select c_custkey, c_acctbal from customer order by -c_acctbal, c_custkey",
)
def sort_negated(t):
    return t.customer.select("c_custkey", "c_acctbal").sort(-F.col("c_acctbal"), "c_custkey")


@query(
    "sort_custom",
    """select o_orderkey, o_orderpriority, cast(case o_orderpriority when '5-LOW' then 1
       when '1-URGENT' then 2 else 3 end as integer) as place from orders
       order by place, o_orderkey""",
)
def sort_custom(t):
    place = listed_order("o_orderpriority", ["5-LOW", "1-URGENT"])
    orders = t.orders.select("o_orderkey", "o_orderpriority", place.alias("place"))
    return orders.orderBy("place", "o_orderkey")


@query("limit_n", "select o_orderkey, o_orderstatus from orders order by o_orderkey limit 25")
def limit_n(t):
    return t.orders.select("o_orderkey", "o_orderstatus").orderBy("o_orderkey").limit(25)


@query(
    "top_k",
    """select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey
       limit 10""",
)
def top_k(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(
    "sample_frac",
    f"select event_id, value from events where md5('7|' || event_id) < '{cut_point(0.2)}'",
)
def sample_frac(t):
    return hash_fraction(t.events.select("event_id", "value"), ["event_id"], 0.2, seed=7)


@query("sample_all", "select event_id, value from events")
def sample_all(t):
    """The whole as a fraction."""
    return hash_fraction(t.events.select("event_id", "value"), ["event_id"], 1.0, seed=7)


@query(
    "sample_n",
    "select event_id, value from events order by md5('7|' || event_id), event_id limit 100",
)
def sample_n(t):
    return hash_take(t.events.select("event_id", "value"), ["event_id"], 100, seed=7)


@query(
    "sample_half",
    """select event_id, value from events order by md5('7|' || event_id), event_id
       limit (select count(*) // 2 from events)""",
)
def sample_half(t):
    """Half of the table, found by counts of the digest and not by sorting it."""
    events = t.events.select("event_id", "value")
    return hash_take(events, ["event_id"], events.count() // 2, seed=7, at_once=20)


@query(
    "sample_draws",
    """with placed as (select event_id, value, row_number() over (order by event_id) - 1 as place
         from events),
       draws as (select draw, ('0x' || substr(md5('7|' || draw), 1, 15))::bigint
         % (select count(*) from events) as place
         from (select unnest(range((select count(*) // 2 from events))) as draw))
       select draw, event_id, value from draws join placed using (place)""",
)
def sample_draws(t):
    """With replacement: half as many draws as there are rows."""
    events = t.events.select("event_id", "value")
    return hash_draws(events, ["event_id"], events.count() // 2, seed=7)


@query(
    "split_hash",
    f"""select event_id, cast(case when md5('7|' || event_id) < '{cut_point(0.6)}' then 0
        when md5('7|' || event_id) < '{cut_point(0.6 + 0.2)}' then 1 else 2 end as integer)
        as part from events""",
)
def split_hash(t):
    return hash_split(t.events.select("event_id"), ["event_id"], [6, 2, 2], seed=7)


@query("sample_bernoulli")
def sample_bernoulli(t):
    return t.events.select("event_id", "value").sample(False, 0.2, seed=7)


@query(
    "filter_range",
    "select o_orderkey, o_totalprice from orders where o_totalprice between 50000 and 200000",
)
def filter_range(t):
    return t.orders.filter(F.col("o_totalprice").between(50000, 200000)).select(
        "o_orderkey", "o_totalprice"
    )


@query(
    "set_union",
    """select n_nationkey as k from nation union all select c_nationkey from customer
       union all select s_nationkey from supplier""",
)
def set_union(t):
    a = t.nation.select(F.col("n_nationkey").alias("k"))
    b = t.customer.select(F.col("c_nationkey").alias("k"))
    c = t.supplier.select(F.col("s_nationkey").alias("k"))
    return a.union(b).unionByName(c)


@query(
    "set_intersect",
    "select l_suppkey as k from lineitem intersect select user_id from events",
)
def set_intersect(t):
    keys = t.lineitem.select(F.col("l_suppkey").alias("k"))
    return common_rows(keys, t.events.select(F.col("user_id").alias("k")))


@query("set_except", "select c_custkey as k from customer except select user_id from events")
def set_except(t):
    customers = t.customer.select(F.col("c_custkey").alias("k"))
    return customers.distinct().subtract(t.events.select(F.col("user_id").alias("k")).distinct())


@query(
    "set_except_all",
    """select o_custkey as k from orders except all select user_id from events""",
)
def set_except_all(t):
    return t.orders.select(F.col("o_custkey").alias("k")).exceptAll(
        t.events.select(F.col("user_id").alias("k"))
    )


@query(
    "set_except_keep",
    """select o_custkey as k from orders
       where not exists (select 1 from events where user_id = o_custkey)""",
)
def set_except_keep(t):
    """The row form of subtract: repeats on the left side stay."""
    orders = t.orders.select(F.col("o_custkey").alias("k"))
    return except_rows(orders, t.events.select(F.col("user_id").alias("k")))


@query(
    "zip_index",
    "select event_id, row_number() over (order by ts, event_id) - 1 as index from events",
)
def zip_index(t):
    return zip_with_index(t.events.select("event_id", "ts"), ["ts", "event_id"]).drop("ts")


@query(
    "flatmap_values",
    """select p_brand as key, upper(unnest(string_split(p_name, ' '))) as item from part""",
)
def flatmap_values(t):
    keyed = t.part.select(F.col("p_brand").alias("key"), "p_name")
    items = keyed.select("key", F.explode(F.split("p_name", " ")).alias("item"))
    return items.withColumn("item", F.upper("item"))
