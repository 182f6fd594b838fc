"""Partition control."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators.partitions import by_rule, partition_sizes, sorted_within, steps_back
from tidemill.registry import query
from tidemill.session import shuffle_count


def summed(sizes):
    """How many partitions hold rows, and how many rows."""
    return sizes.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))


@query("repartition_counts", "select 4 as partitions, count(*)::bigint as rows from orders")
def repartition_counts(t):
    """Eight partitions, then four without a shuffle."""
    eight = t.orders.select("o_orderkey").repartition(8)
    sizes = summed(partition_sizes(eight.coalesce(4)))
    return sizes.withColumn("partitions", F.col("partitions").cast("int"))


@query("repartition_hash", "select o_custkey, 1::bigint as places, count(*) as rows from orders group by 1")
def repartition_hash(t):
    """Equal keys are in one partition."""
    placed = t.orders.select("o_custkey").repartition(shuffle_count(t.spark), "o_custkey")
    per_place = placed.groupBy("o_custkey", F.spark_partition_id().alias("place")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_place.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("places"), F.sum("n").alias("rows")
    )


@query(
    "repartition_range",
    "select 0::bigint as overlaps, count(*)::bigint as rows from orders",
)
def repartition_range(t):
    """Partitions hold ranges that do not overlap; one row per partition is compared."""
    ranged = t.orders.select("o_orderkey").repartitionByRange(
        shuffle_count(t.spark), "o_orderkey"
    )
    spans = ranged.groupBy(F.spark_partition_id().alias("place")).agg(
        F.min("o_orderkey").alias("low"),
        F.max("o_orderkey").alias("high"),
        F.count(F.lit(1)).alias("n"),
    )
    before = F.max("high").over(
        Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    )
    return spans.withColumn("before", before).agg(
        F.count_if(F.col("before") >= F.col("low")).alias("overlaps"), F.sum("n").alias("rows")
    )


@query(
    "repartition_custom",
    """select cast(case when o_custkey > 100 then 1 else 0 end as integer) as partition,
       count(*) as rows from orders group by 1""",
)
def repartition_custom(t):
    rule = F.when(F.col("o_custkey") > 100, 1).otherwise(0)
    return partition_sizes(by_rule(t.orders.select("o_custkey"), 2, rule))


@query(
    "repartition_sorted",
    "select 0::bigint as misplaced, count(*)::bigint as rows from orders",
)
def repartition_sorted(t):
    """Each partition is in order: no row is smaller than the one before it."""
    order = ["o_custkey", "o_orderkey"]
    count = shuffle_count(t.spark)
    placed = sorted_within(t.orders.select(*order), count, ["o_custkey"], order)
    return steps_back(placed, order).agg(
        F.sum("back").alias("misplaced"), F.sum("rows").alias("rows")
    )
