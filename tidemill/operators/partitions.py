"""Placing rows on partitions and looking at the result."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_rule(df: DataFrame, partitions: int, rule: Column) -> DataFrame:
    """The rule names the partition (0 .. partitions-1) of each row."""
    return df.repartitionById(partitions, rule.cast("int"))


def sorted_within(df: DataFrame, partitions: int, keys: list[str], order: list[str]) -> DataFrame:
    """Hash partitions on ``keys``, each sorted by ``order``."""
    return df.repartition(partitions, *keys).sortWithinPartitions(*order)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per partition that has any."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("rows")
    )


def partition_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema
) -> DataFrame:
    """``mapPartitions`` over Arrow batches."""
    return df.mapInArrow(function, schema)


def _steps_back(order: list[str]):
    schema = pa.schema([("back", pa.int64()), ("rows", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            both = pa.Table.from_batches([batch] if last is None else [last, batch])
            back = np.zeros(max(0, both.num_rows - 1), dtype=bool)
            even = np.ones(len(back), dtype=bool)
            for name in order:
                column = both[name].combine_chunks()
                filled = np.asarray(column.is_valid())
                values = np.asarray(column.fill_null(0))
                for part in (filled, np.where(filled, values, 0)):  # NULL comes first
                    back |= even & (part[:-1] > part[1:])
                    even &= part[:-1] == part[1:]
            last = batch.slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(back.sum())]), pa.array([batch.num_rows])], schema=schema
            )

    return task


def steps_back(df: DataFrame, order: list[str]) -> DataFrame:
    """``back, rows`` per batch: how many rows are smaller than the one before them in their
    partition, by whole-number columns. Nothing is shuffled, a task holds one batch."""
    return df.select(*order).mapInArrow(_steps_back(order), "back long, rows long")
