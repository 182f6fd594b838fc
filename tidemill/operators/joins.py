"""Joins that take more than one Spark call."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.plans.bounds import (
    BROADCAST_BYTES,
    checked_broadcast,
    measured_bytes,
    null_safe,
)
from tidemill.plans.ordered import ROWS_PER_TASK, collect_chunks
from tidemill.session import shuffle_count

BUCKET = "_bucket"
CALLS_PER_TASK = 16


def map_side_join(
    df: DataFrame, small: DataFrame, on: str, value: str, default: str = ""
) -> DataFrame:
    """Left join against a side that is broadcast when it is measured to fit;
    ``default`` where it has no row."""
    joined = df.join(checked_broadcast(small), on, "left")
    return joined.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def pair_with_all(
    df: DataFrame, small: DataFrame, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Each row of ``df`` with each row of a small frame, as a row-local explode.

    The small frame becomes one array value, which Spark hands to the tasks; it is measured
    first. The product of two large frames is refused: its size is no longer linear in ``df``.
    """
    if measured_bytes(small) > max_bytes:
        raise ValueError(f"the repeated side has more than {max_bytes} bytes")
    items = small.agg(F.collect_list(F.struct(*small.columns))).scalar()
    paired = df.withColumn("_item", F.explode(items))
    return paired.select(*df.columns, "_item.*")


def common_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows in both; repeats are dropped map-side before the sides meet."""
    return left.distinct().intersect(right.distinct())


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` not in ``right``, repeats in ``left`` kept, NULL equal to NULL."""
    distinct = right.distinct()
    condition = null_safe(left, distinct, [(c, c) for c in left.columns])
    return left.join(distinct, condition, "left_anti")


def cogroup_apply(
    left: DataFrame, right: DataFrame, key: str, function, schema: str, buckets: int | None = None
) -> DataFrame:
    """``function(left rows, right rows)`` with Arrow tables that hold all rows of the keys in a
    bucket, of both sides; a key that only one side has is there too, a missing key is one as well.

    A call costs milliseconds, so keys go by the bucket, of which there are ``CALLS_PER_TASK`` for
    every partition of a shuffle unless given. All groups of a bucket go to one task: where a key may
    be large, pass totals per key (they combine before the shuffle) or use ``cogroup_chunks``."""
    count = buckets or CALLS_PER_TASK * shuffle_count(left.sparkSession)
    bucket = F.pmod(F.xxhash64(key), F.lit(count)).alias(BUCKET)
    a, b = (side.select(bucket, *side.columns).groupBy(BUCKET) for side in (left, right))

    def whole(left_rows: pa.Table, right_rows: pa.Table) -> pa.Table:
        return function(left_rows.drop_columns(BUCKET), right_rows.drop_columns(BUCKET))

    return a.cogroup(b).applyInArrow(whole, schema)


def cogroup_chunks(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_value: str,
    right_value: str,
    chunk_rows: int = 100_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Per key the sorted values of both sides, in rows ``key, side, chunk, items`` of at most
    ``chunk_rows`` values.

    Each side has rows of its own, numbered from chunk 0, so a row means the same for every
    key: a key that only one side has has no row of the other, and a hot key has more chunks, so
    no group has to fit into one task.
    """
    sides = [("left", left, left_value), ("right", right, right_value)]
    a, b = (
        collect_chunks(rows, [key], [value], value, chunk_rows, rows_per_task).select(
            key, F.lit(side).alias("side"), "chunk", "items"
        )
        for side, rows, value in sides
    )
    return a.union(b)


def cogroup_beside(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_value: str,
    right_value: str,
    chunk_rows: int = 100_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Per key the sorted values of both sides beside each other, in arrays of at most
    ``chunk_rows``: rows ``key, chunk, left_items, right_items``.

    A key with fewer values gives one row (chunk 0), as a plain cogroup does; a hot key
    gives several, so that no group has to fit into one task.
    """
    a = collect_chunks(left, [key], [left_value], left_value, chunk_rows, rows_per_task)
    b = collect_chunks(right, [key], [right_value], right_value, chunk_rows, rows_per_task)
    a = a.withColumnRenamed("items", "left_items")
    b = b.withColumnRenamed("items", "right_items")
    return a.join(b, [key, "chunk"], "full")
