"""Joins and aggregates for keys that may hold a large share of all rows.

The salt is a hash of the row's own columns and of the task that reads it: a hot key is spread
over all salts also where a table is sorted by it, copies of one row are spread over tasks, and
a task that is run again gives its rows the same salts.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemill.session import materialize

SALT = "_salt"
HOT = "_hot"
HOT_FRACTION = 0.001

# fixed values: how the partial result of each aggregate is merged
MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def row_salt(df: DataFrame, salts: int) -> Column:
    plain = [
        F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, T.MapType)
    ]
    return F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.lit(salts)).cast("int")


def agg_salted(
    df: DataFrame,
    keys: list[str],
    aggregates: dict[str, tuple[str, Column]],
    salts: int = 8,
) -> DataFrame:
    """Group by (keys, salt), then by keys. ``aggregates``: name -> (kind, column),
    kind one of sum, count, min, max, avg."""
    first, second, finish = [], [], []
    for name, (kind, column) in aggregates.items():
        if kind == "avg":
            first += [F.sum(column).alias(f"{name}_s"), F.count(column).alias(f"{name}_n")]
            second += [F.sum(f"{name}_s").alias(f"{name}_s"), F.sum(f"{name}_n").alias(f"{name}_n")]
            finish.append(F.try_divide(F.col(f"{name}_s"), F.col(f"{name}_n")).alias(name))
        else:
            first.append(PARTIAL[kind](column).alias(name))
            second.append(MERGE[kind](name).alias(name))
            finish.append(F.col(name))
    return (
        df.withColumn(SALT, row_salt(df, salts))
        .groupBy(*keys, SALT)
        .agg(*first)
        .groupBy(*keys)
        .agg(*second)
        .select(*keys, *finish)
    )


def join_salted(
    big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", salts: int = 20
) -> DataFrame:
    """Salt ``big``; repeat each row of ``small`` once per salt. For inner and left joins."""
    if how not in ("inner", "left"):
        raise ValueError("a repeated right side is only right for inner and left joins")
    salted = big.withColumn(SALT, row_salt(big, salts))
    repeated = small.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*on, SALT], how).drop(SALT)


class Frequent:
    """Counts of frequent keys in bounded memory. A count is too low by ``missed`` at most, and
    a key that is left out has been seen ``missed`` times at most; ``missed`` is at most
    rows / size. Summaries are merged by adding counts and ``missed`` up."""

    def __init__(self, size: int):
        self.size, self.counts, self.missed, self.rows = size, {}, 0, 0

    def add(self, keys: list[tuple], counts: list[int]) -> None:
        for key, count in zip(keys, counts):
            self.counts[key] = self.counts.get(key, 0) + count
        self.rows += sum(counts)
        if len(self.counts) > self.size:
            least = heapq.nlargest(self.size + 1, self.counts.values())[-1]
            self.missed += least
            self.counts = {k: n - least for k, n in self.counts.items() if n > least}


def _summarise(keys: list[str], size: int, schema: pa.Schema):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Frequent(size)
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
            columns = [counted.column(k).to_pylist() for k in keys]
            seen.add(list(zip(*columns)), counted.column("count_all").to_pylist())
        # one row of no key has the task's rows and what it may have missed
        rows = [*((*k, n, 0, 0) for k, n in seen.counts.items()), (*[None] * len(keys), 0, seen.missed, seen.rows)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
        )

    return task


def hot_keys(df: DataFrame, keys: list[str], fraction: float = HOT_FRACTION) -> DataFrame:
    """Every key that holds more than ``fraction`` of the rows, from one scan: each task keeps a
    summary of 2 / fraction keys, and only summaries are shuffled. A key of more than half the
    fraction may be listed too, where tasks have met more keys than they keep; so the list has
    at most 2 / fraction keys, which bounds every broadcast of this frame."""
    fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    counts = [T.StructField(c, T.LongType()) for c in ("_n", "_missed", "_rows")]
    schema = T.StructType([*fields, *counts])
    size = math.ceil(2 / fraction)
    rows = df.select(*keys).mapInArrow(_summarise(keys, size, to_arrow_schema(schema)), schema)
    sums = [F.sum(c).alias(c) for c in ("_n", "_missed", "_rows")]
    summary = materialize(rows.groupBy(*keys).agg(*sums), "summary")
    missed, total = summary.agg(F.sum("_missed"), F.sum("_rows")).first()
    least = (total or 0) * fraction - (missed or 0)
    return summary.filter(F.col("_n") > F.lit(least)).where("_n > 0").select(*keys)


def join_hot_split(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    fraction: float = HOT_FRACTION,
    salts: int = 20,
) -> DataFrame:
    """One join: rows of hot keys are salted and meet ``salts`` copies of their row of
    ``small``, all others have salt 0 and one copy. The list of hot keys is written once."""
    if how not in ("inner", "left"):
        raise ValueError("a repeated right side is only right for inner and left joins")
    hot = materialize(hot_keys(big, on, fraction).withColumn(HOT, F.lit(True)), "hot")
    hot = F.broadcast(hot)  # at most 2 / fraction rows
    salted = big.join(hot, on, "left").withColumn(
        SALT, F.when(F.col(HOT), row_salt(big, salts)).otherwise(0)
    )
    copies = F.when(F.col(HOT), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    repeated = small.join(hot, on, "left").withColumn(SALT, F.explode(copies)).drop(HOT)
    return salted.drop(HOT).join(repeated, [*on, SALT], how).drop(SALT)


def join_full_split(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full outer join as left join + unmatched right rows.

    AQE does not split skewed partitions of a full outer join; it does for both
    halves here, and the second half needs only the distinct left keys.
    """
    matched = left.join(right, on, "left")
    unmatched = right.join(left.select(*on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
