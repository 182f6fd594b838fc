"""Projections, predicates and conditionals."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions.text import cell_items
from tidemill.operators.columns import any_present, lookup, recode
from tidemill.registry import query

# fixed values: points per action
POINTS = {"view": 1, "click": 2, "signup": 2, "purchase": 5}
POINTS_SQL = "(values ('view', 1), ('click', 2), ('signup', 2), ('purchase', 5)) r(event_type, points)"

LABELLED_SQL = """
    select d.doc_id, d.lang, l.quality, l.toxic
    from documents d left join labels l on d.doc_id = l.doc_id"""


def labelled(t):
    """Documents with their labels; NULL where a document has none."""
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")


def points_table(t):
    return t.spark.createDataFrame(list(POINTS.items()), "event_type string, points int")


@query("project", "select c_custkey, c_name from customer")
def project(t):
    return t.customer.select("c_custkey", F.col("c_name"))


@query(
    "project_arith",
    """select l_orderkey, l_linenumber, l_quantity + 1 as quantity_next,
       l_quantity + l_extendedprice + l_discount + l_tax as row_sum from lineitem""",
)
def project_arith(t):
    c = F.col
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (c("l_quantity") + 1).alias("quantity_next"),
        (c("l_quantity") + c("l_extendedprice") + c("l_discount") + c("l_tax")).alias("row_sum"),
    )


@query(
    "select_expr",
    """select o_orderkey as id, o_totalprice * 2 as doubled, sqrt(o_totalprice) as root,
       upper(o_orderpriority) as priority from orders""",
)
def select_expr(t):
    return t.orders.selectExpr(
        "o_orderkey AS id",
        "o_totalprice * 2 AS doubled",
        "sqrt(o_totalprice) AS root",
        "upper(o_orderpriority) AS priority",
    )


@query(
    "with_drop_rename",
    """select s_suppkey as supplier, s_name, s_acctbal, s_acctbal / 100 as hundreds
       from supplier""",
)
def with_drop_rename(t):
    return (
        t.supplier.withColumn("hundreds", F.col("s_acctbal") / 100)
        .withColumnRenamed("s_suppkey", "supplier")
        .drop("s_nationkey")
    )


@query(
    "cast_types",
    """select event_id, cast(event_id as varchar) as id_text, cast(trunc(value) as bigint) as whole,
       cast(user_id as double) as user_number, cast(ts as date) as day,
       try_cast(event_type as integer) as not_a_number from events""",
)
def cast_types(t):
    c = F.col
    return t.events.select(
        "event_id",
        c("event_id").cast("string").alias("id_text"),
        c("value").cast("bigint").alias("whole"),
        c("user_id").cast("double").alias("user_number"),
        c("ts").cast("date").alias("day"),
        c("event_type").try_cast("int").alias("not_a_number"),
    )


@query(
    "literal_columns",
    "select p_partkey, 1 as one, 'fixed' as tag, cast(null as varchar) as nothing from part",
)
def literal_columns(t):
    return t.part.select(
        "p_partkey",
        F.lit(1).alias("one"),
        F.lit("fixed").alias("tag"),
        F.lit(None).cast("string").alias("nothing"),
    )


@query(
    "filter_expr",
    """select o_orderkey, o_custkey, o_totalprice from orders
       where (o_orderstatus = 'F' and o_totalprice > 100000) or o_orderpriority = '1-URGENT'""",
)
def filter_expr(t):
    return (
        t.orders.where("o_totalprice > 0")
        .filter(
            ((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
            | (F.col("o_orderpriority") == "1-URGENT")
        )
        .select("o_orderkey", "o_custkey", "o_totalprice")
    )


@query(
    "null_filter",
    f"""select doc_id, 'missing' as state from ({LABELLED_SQL}) where quality is null
       union all
       select doc_id, 'present' as state from ({LABELLED_SQL}) where quality is not null""",
)
def null_filter(t):
    rows = labelled(t)
    missing = rows.filter(F.col("quality").isNull())
    present = rows.where("quality is not null")
    return missing.select("doc_id", F.lit("missing").alias("state")).union(
        present.select("doc_id", F.lit("present").alias("state"))
    )


@query(
    "any_not_null",
    f"""select * from ({LABELLED_SQL}) where quality is not null or toxic is not null""",
)
def any_not_null(t):
    return labelled(t).filter(any_present("quality", "toxic"))


@query(
    "filter_like",
    "select p_partkey, p_name from part where p_name like 'r%' or p_type like '%AR%'",
)
def filter_like(t):
    return t.part.filter(F.col("p_name").like("r%") | F.col("p_type").like("%AR%")).select(
        "p_partkey", "p_name"
    )


@query(
    "filter_length",
    "select o_orderkey, o_orderstatus from orders where length(o_orderstatus) = 1",
)
def filter_length(t):
    return t.orders.filter(F.length("o_orderstatus") == 1).select("o_orderkey", "o_orderstatus")


@query(
    "case_when",
    """select event_id, case when value < 10 then 'low' when value < 100 then 'middle'
       else 'high' end as band from events""",
)
def case_when(t):
    value = F.col("value")
    band = F.when(value < 10, "low").when(value < 100, "middle").otherwise("high")
    return t.events.select("event_id", band.alias("band"))


@query(
    "flatmap_split",
    """select p_partkey, trim(unnest(string_split(p_name, ' '))) as item from part""",
)
def flatmap_split(t):
    return t.part.select("p_partkey", F.explode(cell_items("p_name", " ")).alias("item"))


@query(
    "recode_label",
    """select event_id, cast(case event_type when 'purchase' then 1 else 0 end as double) as label
       from events where event_type in ('purchase', 'error')""",
)
def recode_label(t):
    label = recode("event_type", {"purchase": 1.0, "error": 0.0})
    return t.events.select("event_id", label.alias("label")).filter(F.col("label").isNotNull())


@query(
    "lookup_default",
    f"""select e.event_id, coalesce(r.points, 0) as points
       from events e left join {POINTS_SQL} on e.event_type = r.event_type""",
)
def lookup_default(t):
    events = t.events.select("event_id", "event_type")
    return lookup(events, points_table(t), "event_type", "points", 0).select("event_id", "points")
