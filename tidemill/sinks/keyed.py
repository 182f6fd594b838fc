"""Sinks that may be run again: keyed upsert, writes by batch id, staged loads, metrics.

None of them needs a table format with transactions; each rewrites whole partitions, so
a second run of the same batch leaves the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.plans.bounds import checked_broadcast, null_safe
from tidemill.session import materialize
from tidemill.sinks.files import write_partitioned

BATCH = "batch_id"


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key; a ``max`` over structs, no window."""
    leading = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in leading]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*leading, *rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """``base`` with the changes put in; of several changes of a key the last one counts.

    Only the changes are grouped, once. The base is not shuffled when the changed keys are
    measured to fit a broadcast. A NULL key is a key like any other.
    """
    latest = materialize(latest_per_key(changes, keys, [sequence]).select(*base.columns), "latest")
    changed = checked_broadcast(latest.select(*keys))
    same = null_safe(base, changed, [(k, k) for k in keys])
    return base.join(changed, same, "left_anti").unionByName(latest)


def upsert_partitions(
    base_path: str, changes: DataFrame, keys: list[str], sequence: str, partition: str
) -> None:
    """Upsert into a partitioned folder, rewriting only the partitions that change.

    A changed key may move to another partition: the partitions that now hold it are found
    by reading the keys alone. The new rows are written aside first, because Spark cannot
    replace files that it is still reading. A partition that loses its last row is removed.
    A reader may meet the folder between two of these steps; ``versions`` shows a change whole.
    """
    spark = changes.sparkSession
    base = spark.read.parquet(base_path)
    changed = checked_broadcast(changes.select(*keys).distinct())
    held = base.select(*keys, partition)
    same = null_safe(held, changed, [(k, k) for k in keys])
    old = held.join(changed, same, "left_semi").select(partition)
    touched = materialize(old.union(changes.select(partition)).distinct(), "touched")
    near = checked_broadcast(touched)
    affected = base.join(near, null_safe(base, near, [(partition, partition)]), "left_semi")
    staged = materialize(
        upsert(affected, changes, keys, sequence).select(*base.columns), "upsert"
    )
    write_partitioned(staged, base_path, [partition], "overwrite")
    left = staged.select(partition).distinct()
    emptied = touched.join(left, null_safe(touched, left, [(partition, partition)]), "left_anti")
    clear_partitions(spark, base_path, partition, emptied)


def clear_partitions(spark, base_path: str, partition: str, values: DataFrame) -> None:
    """Empty the folders of these values, a folder at a time, under the names that Spark gives."""
    schema = spark.read.parquet(base_path).drop(partition).schema
    spelled = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for row in values.select(F.col(partition).cast("string")).toLocalIterator():
        value = "__HIVE_DEFAULT_PARTITION__" if row[0] is None else spelled.escapePathName(row[0])
        nothing = spark.createDataFrame([], schema)
        writer = nothing.write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.parquet(f"{base_path}/{partition}={value}")


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """The rows of one batch as one partition: written again, they replace themselves, also
    when the batch has become empty."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.parquet(f"{path.rstrip('/')}/{BATCH}={batch_id}")


def staged_append(df: DataFrame, batch_id: int, stage: str, target: str) -> None:
    """Fill the stage, load the target from it, empty the stage."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(stage)
    write_batch(spark.read.schema(df.schema).parquet(stage), batch_id, target)
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(stage)


def metric_rows(df: DataFrame, event: str | Column, moment: str | Column, value: Column):
    """Long table (rowkey, event, ts, value, day) with rowkey ``event-epochmillis``."""
    event = F.lit(event) if isinstance(event, str) else event
    moment = F.col(moment) if isinstance(moment, str) else moment
    rows = df.select(event.alias("event"), moment.cast("timestamp").alias("ts"), value.alias("value"))
    return rows.select(
        F.concat_ws("-", "event", F.unix_millis("ts")).alias("rowkey"),
        "event",
        "ts",
        "value",
        F.col("ts").cast("date").alias("day"),
    )


def live_metrics(
    metrics: DataFrame, now: Column, ttl_hours: int = 24, versions: int = 10
) -> DataFrame:
    """Rows younger than the time to live, at most ``versions`` newest per rowkey.

    The bound on ``day`` lets Spark skip the folders of expired days.
    """
    since = now - F.make_interval(hours=F.lit(ttl_hours))
    newest = Window.partitionBy("rowkey").orderBy(F.col("ts").desc(), F.col("value").desc())
    return (
        metrics.filter((F.col("day") >= since.cast("date")) & (F.col("ts") >= since))
        .withColumn("_version", F.row_number().over(newest))
        .filter(F.col("_version") <= versions)
        .drop("_version")
    )
