"""Sources and sinks: written from the tables, read back, compared with the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemill.sinks import files as file_sinks
from tidemill.sinks import keyed
from tidemill.sinks.versions import Store, expire_metrics
from tidemill.sources import files, jdbc, kafka
from tidemill.session import work_path
from tidemill.registry import query
from tidemill.streaming import offsets
from tidemill.tables import SCHEMAS

ORDERS_SQL = "select * from orders"


def table_name(label: str) -> str:
    return f"tidemill_{label}_{uuid.uuid4().hex[:12]}"


@query("scan_parquet", "select * from supplier")
def scan_parquet(t):
    return t.spark.read.schema(SCHEMAS["supplier"]).load(t.path("supplier"))


@query("scan_csv", ORDERS_SQL)
def scan_csv(t):
    path = work_path(t.spark, "csv")
    file_sinks.write_csv(t.orders, path, sep=";")
    return files.read_csv(t.spark, path, SCHEMAS["orders"], sep=";")


@query("scan_csv_positional", "select * from customer")
def scan_csv_positional(t):
    path = work_path(t.spark, "csv")
    t.customer.write.csv(path)
    return files.read_csv_positional(t.spark, path, SCHEMAS["customer"])


def damaged_orders(t):
    """The orders as text, some prices without digits and some hours beyond the day."""
    key = F.col("o_orderkey")
    hour = F.when(key % 11 == 0, F.lit(" 25:10")).otherwise(F.lit(" 23:10"))
    return t.orders.select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 7 == 0, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(key % 5 != 0, F.concat(F.date_format("o_orderdate", "yyyy/MM/dd"), hour)).alias("at"),
    )


READ_AS = "o_orderkey bigint, o_totalprice double, at timestamp_ntz"
AT = {"at": "yyyy/MM/dd HH:mm"}


@query(
    "ingest_rejects",
    """select 'o_orderkey' as "column", count(*) as present, 0 as rejected from orders union all
       select 'o_totalprice', count(*), count(*) filter (o_orderkey % 7 = 0) from orders union all
       select 'at', count(*) filter (o_orderkey % 5 <> 0),
         count(*) filter (o_orderkey % 5 <> 0 and o_orderkey % 11 = 0) from orders""",
)
def ingest_rejects(t):
    """Texts that do not fit their column's type, counted per column."""
    path = work_path(t.spark, "damaged")
    damaged_orders(t).write.csv(path)
    texts = t.spark.read.schema("o_orderkey string, o_totalprice string, at string").csv(path)
    return files.reject_counts(texts, READ_AS, AT)


@query(
    "ingest_quarantine",
    """select o_orderkey, case when o_orderkey % 7 = 0 then 'o_totalprice' else '' end
         || case when o_orderkey % 35 <> 0 and o_orderkey % 77 = 0 then ',' else '' end
         || case when o_orderkey % 5 <> 0 and o_orderkey % 11 = 0 then 'at' else '' end as faults
       from orders where o_orderkey % 7 = 0 or (o_orderkey % 5 <> 0 and o_orderkey % 11 = 0)""",
)
def ingest_quarantine(t):
    """The rows themselves, with the columns at fault."""
    bad = files.rejected_rows(damaged_orders(t), READ_AS, AT)
    return bad.select(F.col("o_orderkey").cast("bigint"), F.concat_ws(",", "faults").alias("faults"))


@query("scan_json", "select * from events")
def scan_json(t):
    path = work_path(t.spark, "json")
    file_sinks.write_json(t.events, path)
    return files.read_json(t.spark, path, SCHEMAS["events"])


@query("scan_orc", "select * from part")
def scan_orc(t):
    path = work_path(t.spark, "orc")
    t.part.write.orc(path)
    return files.read_any(t.spark, "orc", path, SCHEMAS["part"])


@query("scan_text", "select c_custkey, c_nationkey, c_acctbal from customer")
def scan_text(t):
    path = work_path(t.spark, "text")
    line = F.concat_ws("\t", "c_custkey", "c_nationkey", "c_acctbal")
    t.customer.select(line.alias("value")).write.text(path)
    return files.read_delimited_text(
        t.spark, path, "c_custkey bigint, c_nationkey int, c_acctbal double"
    )


@query("scan_table", "select * from part")
def scan_table(t):
    name = table_name("part")
    file_sinks.create_table(t.part, name, work_path(t.spark, "table"))
    return t.spark.table(name)


@query(
    "scan_range",
    """select r.id, o.o_orderkey is not null as taken from
       range(5, (select max(o_orderkey) from orders) + 1000, 5) r(id)
       left join orders o on o.o_orderkey = r.id""",
)
def scan_range(t):
    highest = t.orders.agg(F.max("o_orderkey")).first()[0]
    grid = t.spark.range(5, highest + 1000, 5)
    return grid.join(t.orders.select("o_orderkey"), F.col("id") == F.col("o_orderkey"), "left").select(
        "id", F.col("o_orderkey").isNotNull().alias("taken")
    )


@query(
    "scan_range_predicates",
    """with b as (select min(o_orderkey) as lo, max(o_orderkey) as hi from orders)
       select cast((o_orderkey - lo) * 4 // (hi - lo + 1) as integer) as part, count(*) as cnt,
       min(o_orderkey) as low, max(o_orderkey) as high from orders, b group by 1""",
)
def scan_range_predicates(t):
    """The ranges of a split JDBC read, applied to a table."""
    low, high = t.orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    chain = None
    for number, predicate in enumerate(jdbc.range_predicates("o_orderkey", low, high, 4)):
        test = F.expr(predicate)
        chain = F.when(test, number) if chain is None else chain.when(test, number)
    return (
        t.orders.select("o_orderkey", chain.alias("part"))
        .groupBy("part")
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.min("o_orderkey").alias("low"),
            F.max("o_orderkey").alias("high"),
        )
    )


@query("sink_parquet", ORDERS_SQL)
def sink_parquet(t):
    path = work_path(t.spark, "parquet")
    t.orders.filter(F.col("o_orderstatus") == "F").write.save(path)
    t.orders.filter(F.col("o_orderstatus") != "F").write.mode("append").save(path)
    return t.spark.read.schema(SCHEMAS["orders"]).parquet(path)


@query("sink_csv", "select c_custkey, c_name from customer")
def sink_csv(t):
    path = work_path(t.spark, "csv")
    names = t.customer.select("c_custkey", "c_name")
    names.write.csv(path, header=True)
    names.write.mode("overwrite").option("header", True).option("delimiter", "|").csv(path)
    return files.read_csv(t.spark, path, names.schema, sep="|")


@query("sink_text", "select p_name as value from part")
def sink_text(t):
    path = work_path(t.spark, "text")
    file_sinks.write_text(t.part, "p_name", path)
    return t.spark.read.text(path)


@query(
    "sink_table_partitioned",
    """select o_orderkey, case when o_orderstatus = 'F' then -o_totalprice else o_totalprice end
       as o_totalprice, o_orderstatus from orders""",
)
def sink_table_partitioned(t):
    """Partitioned catalog table; one partition is replaced, the others stay."""
    name = table_name("orders")
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    file_sinks.create_table(orders, name, work_path(t.spark, "table"), ["o_orderstatus"])
    turned = orders.filter(F.col("o_orderstatus") == "F").withColumn(
        "o_totalprice", -F.col("o_totalprice")
    )
    file_sinks.replace_partitions(turned, name)
    return t.spark.table(name)


@query(
    "kafka_payload",
    """select cast(user_id as varchar) as key, to_json(struct_pack(event_id := event_id,
       event_type := event_type, props := props))::varchar as value, 'events' as topic
       from events""",
)
def kafka_payload(t):
    return kafka.payload(t.events, "user_id", ["event_id", "event_type", "props"], "events")


CHANGED_SQL = """select o_orderkey, o_custkey, 'X' as o_orderstatus, o_totalprice + 1 as
    o_totalprice, o_orderdate, o_orderpriority from orders where o_orderpriority = '1-URGENT'"""


def order_changes(t):
    """Two changes of each urgent order; the second one is to win."""
    urgent = t.orders.filter(F.col("o_orderpriority") == "1-URGENT")
    first = urgent.withColumn("o_orderstatus", F.lit("W")).withColumn("seq", F.lit(1))
    second = (
        urgent.withColumn("o_orderstatus", F.lit("X"))
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
        .withColumn("seq", F.lit(2))
    )
    return first.unionByName(second)


@query(
    "upsert_latest",
    f"{ORDERS_SQL} where o_orderpriority <> '1-URGENT' union all {CHANGED_SQL}",
)
def upsert_latest(t):
    return keyed.upsert(t.orders, order_changes(t), ["o_orderkey"], "seq")


@query(
    "upsert_partitions",
    f"{ORDERS_SQL} where o_orderpriority <> '1-URGENT' union all {CHANGED_SQL}",
)
def upsert_partitions(t):
    """The same upsert into a folder partitioned by priority; one partition is rewritten."""
    path = work_path(t.spark, "orders")
    file_sinks.write_partitioned(t.orders, path, ["o_orderpriority"])
    keyed.upsert_partitions(path, order_changes(t), ["o_orderkey"], "seq", "o_orderpriority")
    return t.spark.read.schema(SCHEMAS["orders"]).parquet(path)


@query(
    "staged_append",
    "select event_id, value, cast(7 as bigint) as batch_id from events",
)
def staged_append(t):
    """A batch loaded twice through the stage is there once."""
    stage, target = work_path(t.spark, "stage"), work_path(t.spark, "target")
    rows = t.events.select("event_id", "value")
    for _ in range(2):
        keyed.staged_append(rows, 7, stage, target)
    return t.spark.read.schema("event_id bigint, value double, batch_id bigint").parquet(target)


@query(
    "metric_store",
    """select event_type || '-' || cast(epoch(date_trunc('second', ts)) * 1000 as bigint)
       as rowkey, value from events where ts >= (select max(ts) from events) - interval 24 hours
       qualify row_number() over (partition by event_type, date_trunc('second', ts)
         order by ts desc, value desc) <= 10""",
)
def metric_store(t):
    """Metrics by day, read with a time to live of 24 hours and 10 versions per key."""
    path = work_path(t.spark, "metrics")
    events = t.events.select("event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    rows = keyed.metric_rows(events, F.col("event_type"), "ts", F.col("value"))
    second = F.unix_seconds("ts") * 1000
    rows = rows.withColumn("rowkey", F.concat_ws("-", "event", second))
    file_sinks.write_partitioned(rows, path, ["day"])
    stored = t.spark.read.schema(rows.schema).parquet(path)
    now = F.lit(stored.agg(F.max("ts")).first()[0])
    return keyed.live_metrics(stored, now).select("rowkey", "value")


LOG_SQL = """select 'g' || (l_suppkey % 2) as grp, l_returnflag as topic, l_linenumber as part,
    l_orderkey as "offset", l_shipdate as ts from lineitem"""


def offset_log(t):
    return t.lineitem.select(
        F.concat(F.lit("g"), F.col("l_suppkey") % 2).alias("grp"),
        F.col("l_returnflag").alias("topic"),
        F.col("l_linenumber").alias("part"),
        F.col("l_orderkey").alias("offset"),
        F.col("l_shipdate").alias("ts"),
    )


@query(
    "latest_offsets",
    f"""select grp, topic, part, "offset" from ({LOG_SQL}) qualify row_number() over
        (partition by grp, topic, part order by ts desc, "offset" desc) = 1""",
)
def latest_offsets(t):
    return offsets.latest_offsets(offset_log(t))


@query(
    "offset_clamp",
    f"""with log as ({LOG_SQL}),
        bounds as (select topic, part, min("offset") + 100 as low,
          max("offset") - 100 as high from log group by 1, 2),
        stored as (select topic, part, case when part % 3 = 0 then 0
          when part % 3 = 1 then max("offset") else min("offset") + 500 end as o
          from log where part <> 7 group by 1, 2)
        select b.topic, b.part, greatest(b.low, least(b.high, coalesce(s.o, 0))) as start_offset
        from bounds b left join stored s on b.topic = s.topic and b.part = s.part""",
)
def offset_clamp(t):
    log = offset_log(t)
    low, high = F.min("offset"), F.max("offset")
    bounds = log.groupBy("topic", "part").agg((low + 100).alias("low"), (high - 100).alias("high"))
    third = F.col("part") % 3
    stored = (
        log.filter(F.col("part") != 7)
        .groupBy("topic", "part")
        .agg(low.alias("lo"), high.alias("hi"))
        .withColumn(
            "offset",
            F.when(third == 0, F.lit(0)).when(third == 1, F.col("hi")).otherwise(F.col("lo") + 500),
        )
    )
    return offsets.clamp(stored, bounds)


MOVED = "'é@b,+&/x'"


@query(
    "upsert_versions",
    f"""{ORDERS_SQL} where o_orderpriority <> '1-URGENT' union all
        select * replace (case when o_orderkey % 2 = 0 then {MOVED} else o_orderpriority end
          as o_orderpriority) from ({CHANGED_SQL})""",
)
def upsert_versions(t):
    """Upserts into a store by priority, one version each: first half of the urgent orders move to
    a priority of odd letters, then all are changed again and move on as the last change says."""
    store = Store(t.spark, work_path(t.spark, "store"))
    change = store.change()
    change.put("orders", t.orders, by="o_orderpriority")
    change.commit()
    rows = order_changes(t)
    moved = F.when(F.col("o_orderkey") % 2 == 0, F.expr(MOVED)).otherwise(F.col("o_orderpriority"))
    for part in (rows.where("seq = 1"), rows.withColumn("o_orderpriority", moved)):
        change = store.change()
        change.upsert("orders", part, ["o_orderkey"], "seq", by="o_orderpriority")
        change.commit()
    return store.read("orders")


@query(
    "metric_expiry",
    """select event_type || '-' || cast(epoch(date_trunc('second', ts)) * 1000 as bigint)
       as rowkey, value from events where ts >= (select max(ts) from events) - interval 36 hours
       qualify row_number() over (partition by event_type, date_trunc('second', ts)
         order by ts desc, value desc) <= 1""",
)
def metric_expiry(t):
    """Everything the store still holds after a compaction: 36 hours, one version a key."""
    events = t.events.select("event_type", "value", F.col("ts").cast("timestamp").alias("ts"))
    rows = keyed.metric_rows(events, F.col("event_type"), "ts", F.col("value"))
    rows = rows.withColumn("rowkey", F.concat_ws("-", "event", F.unix_seconds("ts") * 1000))
    store = Store(t.spark, work_path(t.spark, "metrics"))
    change = store.change()
    change.put("metrics", rows, by="day")
    change.commit()
    now = F.lit(store.read("metrics").agg(F.max("ts")).first()[0])
    expire_metrics(store, "metrics", now, ttl_hours=36, versions=1)
    store.forget(1)
    return store.read("metrics").select("rowkey", "value")


def bucketed_orders(t) -> tuple[str, str]:
    """Orders and their lines, stored by order key."""
    orders, lines = table_name("orders"), table_name("lines")
    file_sinks.create_bucketed(t.orders, orders, ["o_orderkey"])
    file_sinks.create_bucketed(t.lineitem, lines, ["l_orderkey"])
    return orders, lines


@query(
    "join_stored_layout",
    """select o_orderpriority, l_returnflag, count(*) as lines, count(distinct o_orderkey) as orders
       from orders join lineitem on o_orderkey = l_orderkey group by 1, 2""",
)
def join_stored_layout(t):
    """Two queries on one stored layout: a join by order, and orders counted by what it gave."""
    orders, lines = bucketed_orders(t)
    per_order = joined_by_layout(t.spark, orders, lines)
    return per_order.groupBy("o_orderpriority", "l_returnflag").agg(
        F.sum("n").alias("lines"), F.count(F.lit(1)).alias("orders")
    )


def joined_by_layout(spark, orders: str, lines: str):
    a, b = spark.table(orders).hint("merge"), spark.table(lines)
    joined = a.join(b, F.col("o_orderkey") == F.col("l_orderkey"))
    keys = ["o_orderkey", "o_orderpriority", "l_returnflag"]
    return joined.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
