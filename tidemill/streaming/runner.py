"""Running streaming queries and reading what they wrote."""

from __future__ import annotations

import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemill.session import STATE_PARTITIONS, work_path
from tidemill.sinks.keyed import BATCH, write_batch

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTITIONS = "spark.sql.shuffle.partitions"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # counting rows asks the store for each key before it is written; nothing reads that count
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


@contextmanager
def stream_conf(spark: SparkSession, partitions: int | None = None):
    """State on disk (RocksDB) and a state-partition count that fits the cluster.

    The count is fixed by a query's first start for the life of its checkpoint, so it is the
    given one, or what the input asks for (``size_states``) and at most the session's number of
    shuffle partitions; only a local session, which has its cores for good, takes those.
    """
    context = spark.sparkContext
    if partitions is None and context.master.startswith("local["):
        partitions = context.defaultParallelism
    if partitions is None:
        partitions = int(spark.conf.get(PARTITIONS))
        partitions = min(partitions, int(spark.conf.get(STATE_PARTITIONS, str(partitions))))
    wanted = {**STATE_CONF, PARTITIONS: str(partitions)}
    before = {k: spark.conf.get(k, None) for k in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` query; its failure is raised here."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


def run_each_batch(df: DataFrame, handle, checkpoint: str, mode: str = "append") -> None:
    """Give every micro-batch to ``handle(frame, batch_id)`` until the input is used up."""
    with stream_conf(df.sparkSession):
        writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        finish(writer.foreachBatch(handle).trigger(availableNow=True).start())


def run_to_files(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by=()
) -> None:
    """Append mode into the file sink."""
    with stream_conf(df.sparkSession):
        writer = df.writeStream.format(fmt).outputMode("append").option("path", path)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer = writer.option("checkpointLocation", checkpoint)
        finish(writer.trigger(availableNow=True).start())


def save_batches(
    df: DataFrame, prefix: str, checkpoint: str, suffix: str = "", fmt: str = "text"
) -> None:
    """One folder ``prefix-<batch id><suffix>`` per micro-batch, replaced if it is repeated."""

    def handle(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").format(fmt).save(f"{prefix}-{batch_id}{suffix}")

    run_each_batch(df, handle, checkpoint)


def run_to_memory(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """Memory sink: the result is held by the driver, so only for a few rows."""
    spark = df.sparkSession
    with stream_conf(spark):
        writer = df.writeStream.format("memory").queryName(name).outputMode(mode)
        finish(writer.trigger(availableNow=True).start())
    return spark.table(name)


def appended(df: DataFrame, label: str) -> DataFrame:
    """Run to the end in append mode and read the files."""
    spark = df.sparkSession
    path = work_path(spark, label)
    run_to_files(df, path, work_path(spark, f"{label}-checkpoint"))
    return spark.read.schema(df.schema).parquet(path)


def batches(df: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """Run to the end; every micro-batch is one partition ``batch_id`` of the result."""
    spark = df.sparkSession
    path = work_path(spark, label)

    def handle(frame: DataFrame, batch_id: int) -> None:
        write_batch(frame, batch_id, path)

    run_each_batch(df, handle, work_path(spark, f"{label}-checkpoint"), mode)
    schema = T.StructType([*df.schema.fields, T.StructField(BATCH, T.LongType())])
    return spark.read.schema(schema).parquet(path)


def updated(df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Run to the end in update mode; the last update of each key."""
    return last_update(batches(df, label, "update"), keys)


def last_update(updates: DataFrame, keys: list[str]) -> DataFrame:
    """Grouped by key with a ``max`` over structs, so old updates go before the shuffle."""
    rest = [c for c in updates.columns if c not in keys and c != BATCH]
    newest = updates.groupBy(*keys).agg(F.max(F.struct(BATCH, *rest)).alias("_row"))
    return newest.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def completed(df: DataFrame, label: str) -> DataFrame:
    """Run to the end in complete mode; the result table of the last batch."""
    written = batches(df, label, "complete")
    last = written.agg(F.max(BATCH)).first()[0]
    return written.filter(F.col(BATCH) == F.lit(last)).drop(BATCH)


def stop_on_marker(
    query: StreamingQuery,
    marker: str,
    poll_seconds: float = 1.0,
    spark: SparkSession | None = None,
) -> bool:
    """Stop the query after its current batch once the marker file exists, on whatever store.

    True if it was the marker that stopped it.
    """
    spark = spark or SparkSession.getActiveSession()
    path = spark._jvm.org.apache.hadoop.fs.Path(marker)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    while not query.awaitTermination(poll_seconds):
        if store.exists(path):
            while query.status["isTriggerActive"]:
                time.sleep(min(poll_seconds, 0.1))
            query.stop()
            return True
    return False
