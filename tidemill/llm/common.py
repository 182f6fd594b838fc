"""Helpers of the corpus operators: text columns, salts, connected components."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.session import materialize, ship_package

# the six characters that bytes.split() takes as white space, which the contracts name
BLANKS = b" \t\n\x0b\x0c\r"


def raw_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text as UTF-8 bytes; a null text is empty. Other columns,
    whatever their names, are left behind. The tasks that read it can import this package."""
    ready(docs.sparkSession)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw"),
    )


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 512  # whole texts that are handed to Python at once, unless the session says so
TEXTS_AT_ONCE = 3 << 20  # bytes of text that are worked on together


def ready(spark: SparkSession) -> None:
    """The tasks can import this package, and a batch holds few texts: Spark bounds it by rows
    alone, and texts may be long."""
    ship_package(spark)
    if spark.conf.get(ROWS_PER_BATCH, None) is None:
        spark.conf.set(ROWS_PER_BATCH, str(BATCH_ROWS))


def text_groups(
    batches: Iterator[pa.RecordBatch], *names: str, text: str = "raw", most: int = TEXTS_AT_ONCE
) -> Iterator[tuple[list[tuple], list[bytes]]]:
    """The rows of all batches in groups of about ``most`` bytes of text: the values of the
    named columns, and the texts. One long text is a group of its own."""
    rows: list[tuple] = []
    texts: list[bytes] = []
    size = 0
    for batch in batches:
        columns = [batch[name].to_pylist() for name in names]
        for row, value in zip(zip(*columns), batch[text].to_pylist()):
            rows.append(row)
            texts.append(value)
            size += len(value)
            if size >= most:
                yield rows, texts
                rows, texts, size = [], [], 0
    if texts:
        yield rows, texts


def batch_of(schema: pa.Schema, columns: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def free_shuffles(spark: SparkSession) -> None:
    """After a written cut, have the driver forget the plans before it: Spark deletes shuffle
    files when their plan is garbage, which a driver with memory to spare notices late. What
    Python held is garbage in the first round, what that held in the second."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def own_name(label: str) -> str:
    """A column name that no input column has."""
    return f"__{label}_{uuid.uuid4().hex[:8]}"


def row_key(doc_id: Column, tag: Column) -> Column:
    """One text key for (doc_id, tag); a null doc_id is a key like any other."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("long").cast("string"), F.lit("null")), tag)


def keep_rows(docs: DataFrame, kept: DataFrame, tag: Column) -> DataFrame:
    """The rows of ``docs`` whose (doc_id, tag) is in ``kept(doc_id, tag)``, one row of each.

    ``tag`` is a column made from the text; with it rows that share a doc_id are told apart.
    One shuffle of ``docs`` serves both the join and the choice among rows repeated as a
    whole. All columns come back unchanged, whatever their names.
    """
    key, nth = own_name("key"), own_name("nth")
    wanted = kept.select(row_key(F.col("doc_id"), F.col("tag")).alias(key)).distinct()
    joined = docs.withColumn(key, row_key(docs["doc_id"], tag)).join(wanted, key, "left_semi")
    first = Window.partitionBy(key).orderBy(key)
    chosen = joined.withColumn(nth, F.row_number().over(first)).where(F.col(nth) == 1)
    return chosen.select(*[F.col(f"`{c}`") for c in docs.columns])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` of longs: ``node, root`` with the smallest
    node of the component, for every node that has an edge.

    Large and small stars in turn (each node's neighbours are hung on its smallest one).
    A star needs only a minimum per node, which combines before the shuffle, so a hub with
    very many neighbours costs no list; every round is written to the shared folder.
    """
    spark = edges.sparkSession
    now = materialize(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )

    def state(df: DataFrame):
        return df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    before = state(now)
    while before[0]:
        both = now.union(now.select(F.col("b"), F.col("a")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        # every neighbour above the node goes to the node's smallest neighbour
        large = (
            now.select(F.col("b").alias("a"), F.col("a").alias("up"))
            .join(low, "a")
            .select(F.col("up").alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = materialize(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("low"))
        small = (
            large.join(least, "a")
            .select(F.greatest("b", "low").alias("x"), F.least("b", "low").alias("y"))
            .where("x <> y")
            .union(least.select("a", "low"))
            .distinct()
            .toDF("a", "b")
        )
        now = materialize(small, "edges")
        after = state(now)
        if after == before:
            break
        before = after
    if not before[0]:
        return spark.createDataFrame([], "node long, root long")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b"), F.col("b")).distinct()
    )
