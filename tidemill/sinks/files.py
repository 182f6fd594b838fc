"""File and table sinks."""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.sources.files import MICROS

FILE_BYTES = 128 * 1024 * 1024
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One object per line; times keep their microseconds."""
    df.write.mode(mode).options(**MICROS).json(path)


def write_csv(
    df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "errorifexists"
) -> None:
    df.write.mode(mode).options(**MICROS).csv(path, header=header, sep=sep)


def write_text(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> int:
    """Text lines in as few files as their size allows: one file only if it all fits one. The
    lines are dealt out, so that the work before is not drawn into as few tasks."""
    lines = df.select(F.col(column).cast("string").alias("value"))
    size = lines.agg(F.sum(F.octet_length("value").cast("bigint"))).first()[0] or 0
    files = max(1, math.ceil(size / FILE_BYTES))
    lines.repartition(files).write.mode(mode).text(path)
    return files


@contextmanager
def dynamic_overwrite(spark: SparkSession):
    """``insertInto`` replaces only the partitions it writes under this session setting."""
    before = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE_MODE, before)


def balanced(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with equal values side by side, so that a partitioned write makes few files;
    AQE splits a value that is too large for one task."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def create_table(
    df: DataFrame, name: str, path: str, partition_by: list[str] = (), fmt: str = "parquet"
) -> None:
    """Catalog table whose files lie under ``path``."""
    if partition_by:
        df = balanced(df, *partition_by)
    writer = df.write.format(fmt).option("path", path)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def create_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int | None = None) -> None:
    """A catalog table that stays hash-partitioned and sorted by ``keys``: joins and aggregates on
    them over tables with the same number of buckets need no shuffle. The number of buckets is the
    session's shuffle count unless it is given. Rows are shuffled once, so that a bucket is one
    file and not one per task."""
    count = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(count, *keys)
    placed.write.format("parquet").bucketBy(count, *keys).sortBy(*keys).saveAsTable(table)


def write_partitioned(
    df: DataFrame, path: str, columns: list[str], mode: str = "errorifexists"
) -> None:
    """Folder per value; under ``overwrite`` only the folders that occur in ``df`` are replaced."""
    writer = balanced(df, *columns).write.mode(mode)
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def replace_partitions(df: DataFrame, table: str) -> None:
    """Insert by column order, replacing the partitions that occur in ``df``."""
    spark = df.sparkSession
    with dynamic_overwrite(spark):
        df.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)


def save_sequence(df: DataFrame, key: str, value: str, path: str) -> None:
    """Key-value pairs as a sequence file."""
    df.select(key, value).rdd.map(tuple).saveAsSequenceFile(path)


def save_objects(df: DataFrame, path: str) -> None:
    """Rows as pickled objects."""
    df.rdd.map(tuple).saveAsPickleFile(path)
