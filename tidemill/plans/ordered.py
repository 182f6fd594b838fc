"""Ordered computations per key when one key may not fit one task.

``Window.partitionBy(key)`` sends all rows of a key to one task. ``OrderedKeys`` counts the
rows of each key first. Keys of up to ``rows_per_task`` rows take the plain window. The few
larger ones (at most total / rows_per_task of them, so their list may be broadcast) are
range-partitioned by (key, order) into blocks, written once, windowed per (key, block), and
joined with what each block inherits from the blocks before it. At most one key runs on
from one block into the next, so that table has no more rows than there are blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemill.plans.bounds import null_safe
from tidemill.session import materialize

BLOCK = "_block"
POSITION = "_position"
CARRY = "_carry"
TASK = "_task"
ROWS_PER_TASK = 5_000_000

# fixed values: running aggregate -> (aggregate, how two parts are combined)
RUNNING: dict[str, tuple[Callable, Callable[[Column, Column], Column]]] = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "count": (F.count, lambda a, b: F.coalesce(a + b, a, b)),
    "min": (F.min, F.least),
    "max": (F.max, F.greatest),
}


def _sort(name: str) -> Column:
    return F.col(name[1:]).desc() if name.startswith("-") else F.col(name).asc()


def whole_div(column: Column, size: int) -> Column:
    return F.call_function("div", column, F.lit(size))


Frame = Callable[[WindowSpec], Column]


class PlainKeys:
    """One window per key."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str]):
        self.df = df
        self.keys = keys
        self.window = Window.partitionBy(*keys).orderBy(*[_sort(o) for o in order])

    def running(self, name: str, kind: str, column: Column) -> DataFrame:
        frame = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return self.df.withColumn(name, RUNNING[kind][0](column).over(frame))

    def position(self, name: str) -> DataFrame:
        return self.df.withColumn(name, F.row_number().over(self.window).cast("bigint"))

    def framed(self, columns: dict[str, Frame], reach: int) -> DataFrame:
        return self.df.select("*", *[f(self.window).alias(n) for n, f in columns.items()])

    def running_range(self, name: str, kind: str, column: Column) -> DataFrame:
        return self.df.withColumn(name, RUNNING[kind][0](column).over(self.window))

    def ranks(self, rank: str, dense_rank: str) -> DataFrame:
        numbers = {rank: F.rank(), dense_rank: F.dense_rank()}
        return self.df.withColumns(
            {name: f.over(self.window).cast("bigint") for name, f in numbers.items()}
        )

    def totals(self, name: str, aggregate: Column) -> DataFrame:
        return self.df.withColumn(name, aggregate.over(Window.partitionBy(*self.keys)))


class BlockedKeys:
    """Keys that are cut into blocks. ``keys`` may be empty: then the frame is one key."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], rows: int, limit: int):
        self.df = df
        self.keys = keys
        self.order = order
        self.limit = limit
        self.sort = [_sort(o) for o in order]
        self.columns = df.columns
        self.blocks = max(2, math.ceil(rows / limit))
        self._ranged: DataFrame | None = None

    def ranged(self) -> DataFrame:
        """The rows in order over the blocks. Written, so that a block keeps its rows.

        Rows with equal keys and order go by the task that read them, so that any number of
        copies is spread over blocks too.
        """
        if self._ranged is None:
            by = [F.col(k).asc() for k in self.keys] + [*self.sort, F.col(TASK).asc()]
            tasks = self.df.withColumn(TASK, F.spark_partition_id())
            ranged = tasks.repartitionByRange(self.blocks, *by).drop(TASK)
            numbered = ranged.withColumn(BLOCK, F.spark_partition_id())
            self._ranged = materialize(numbered, "blocks")
        return self._ranged

    def _with_carry(self, partial: Column, merged: Callable) -> DataFrame:
        """Each row with the combined ``partial`` of its key's earlier blocks (or NULL)."""
        rows = self.ranged()
        before = (
            Window.partitionBy(*self.keys)
            .orderBy(BLOCK)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        parts = [*self.keys, BLOCK]
        carry = (
            rows.groupBy(*parts)
            .agg(partial.alias("_part"))
            .withColumn(CARRY, merged("_part").over(before))
            .filter(F.col(CARRY).isNotNull())
            .select(*[F.col(c).alias(f"_{c}") for c in parts], CARRY)
        )
        condition = null_safe(rows, carry, [(c, f"_{c}") for c in parts])
        joined = rows.join(F.broadcast(carry), condition, "left")
        return joined.drop(*[f"_{c}" for c in parts])

    def _block_window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*self.sort)

    def running(self, name: str, kind: str, column: Column) -> DataFrame:
        aggregate, combine = RUNNING[kind]
        merged = F.sum if kind in ("sum", "count") else aggregate
        frame = self._block_window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return (
            self._with_carry(aggregate(column), merged)
            .withColumn(name, combine(F.col(CARRY), aggregate(column).over(frame)))
            .select(*self.columns, name)
        )

    def position(self, name: str) -> DataFrame:
        local = F.row_number().over(self._block_window())
        return (
            self._with_carry(F.count(F.lit(1)), F.sum)
            .withColumn(name, F.coalesce(F.col(CARRY), F.lit(0)) + local)
            .select(*self.columns, name)
        )

    def framed(self, columns: dict[str, Frame], reach: int) -> DataFrame:
        """Slices of consecutive positions; rows within ``reach`` of a cut are also given
        to the neighbouring slice and dropped after the window."""
        size = max(self.limit, reach + 1)

        def slice_of(shift: int) -> Column:
            return whole_div(F.col(POSITION) - 1 + shift, size)

        slices = F.array_distinct(F.array("_own", slice_of(-reach), slice_of(reach)))
        spread = (
            self.position(POSITION)
            .withColumn("_own", slice_of(0))
            .withColumn("_slice", F.explode(slices))
        )
        window = Window.partitionBy(*self.keys, "_slice").orderBy(POSITION)
        return (
            spread.select("*", *[f(window).alias(n) for n, f in columns.items()])
            .filter(F.col("_slice") == F.col("_own"))
            .select(*self.columns, *columns)
        )

    def _per_value(self, partial: Column, name: str) -> tuple[DataFrame, list[str]]:
        """One row per key and sort value: rows with equal values are added up first."""
        values = [o.lstrip("-") for o in self.order]
        return self.df.groupBy(*self.keys, *values).agg(partial.alias(name)), values

    def _back(self, per_value: DataFrame, on: list[str], added: list[str]) -> DataFrame:
        right = per_value.select(*[F.col(c).alias(f"_{c}") for c in on], *added)
        condition = null_safe(self.df, right, [(c, f"_{c}") for c in on])
        return self.df.join(right, condition, "left").select(*self.columns, *added)

    def running_range(self, name: str, kind: str, column: Column) -> DataFrame:
        per_value, values = self._per_value(RUNNING[kind][0](column), "_part")
        merged = "sum" if kind in ("sum", "count") else kind
        keyed = OrderedKeys(per_value, self.keys, self.order, self.limit)
        summed = keyed.running(name, merged, F.col("_part"))
        return self._back(summed, [*self.keys, *values], [name])

    def ranks(self, rank: str, dense_rank: str) -> DataFrame:
        per_value, values = self._per_value(F.count(F.lit(1)), "_same")
        large = LargeKeys.measure(per_value, self.keys, self.limit)
        summed = OrderedKeys(per_value, self.keys, self.order, self.limit, large).running(
            "_upto", "sum", F.col("_same")
        )
        numbered = OrderedKeys(summed, self.keys, self.order, self.limit, large).position(
            dense_rank
        )
        ranked = numbered.withColumn(rank, F.col("_upto") - F.col("_same") + 1)
        return self._back(ranked, [*self.keys, *values], [rank, dense_rank])

    def totals(self, name: str, aggregate: Column) -> DataFrame:
        per_key = self.df.groupBy(*self.keys).agg(aggregate.alias(name))
        return self._back(per_key, self.keys, [name])


@dataclass(frozen=True)
class LargeKeys:
    """The keys of more than ``limit`` rows and how many rows they have together.

    One count per key; frames with the same keys and rows may share it.
    """

    rows: int | None
    keys: DataFrame

    @classmethod
    def measure(
        cls, df: DataFrame, keys: list[str], rows_per_task: int = ROWS_PER_TASK
    ) -> LargeKeys:
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        large = materialize(sizes.filter(F.col("_n") > rows_per_task), "large")
        rows = large.agg(F.sum("_n")).first()[0]
        return cls(rows, large.select(*[F.col(k).alias(f"_{k}") for k in keys]))


class OrderedKeys:
    """``order`` names the sort columns, ``-name`` for descending. Methods that count
    rows (``position``, ``running``, ``framed``) need it to be unique within a key."""

    def __init__(
        self,
        df: DataFrame,
        keys: list[str],
        order: list[str],
        rows_per_task: int = ROWS_PER_TASK,
        large: LargeKeys | None = None,
    ):
        keys, order = list(keys), list(order)
        large = large or LargeKeys.measure(df, keys, rows_per_task)
        rows = large.rows
        self.blocked = rows is not None
        if not self.blocked:
            self.parts = [PlainKeys(df, keys, order)]
        elif not keys:
            self.parts = [BlockedKeys(df, keys, order, rows, rows_per_task)]
        else:
            hot = F.broadcast(large.keys)
            condition = null_safe(df, hot, [(k, f"_{k}") for k in keys])
            self.parts = [
                PlainKeys(df.join(hot, condition, "left_anti"), keys, order),
                BlockedKeys(
                    df.join(hot, condition, "left_semi"), keys, order, rows, rows_per_task
                ),
            ]

    def _each(self, call: Callable[[PlainKeys | BlockedKeys], DataFrame]) -> DataFrame:
        frames = [call(part) for part in self.parts]
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def running(self, name: str, kind: str, column: Column) -> DataFrame:
        """sum, count, min or max from the first row of the key up to the current one."""
        return self._each(lambda part: part.running(name, kind, column))

    def position(self, name: str) -> DataFrame:
        """1-based row number within the key."""
        return self._each(lambda part: part.position(name))

    def framed(self, columns: dict[str, Frame], reach: int) -> DataFrame:
        """Window expressions that look at most ``reach`` rows away (lag, lead, ROWS frames)."""
        return self._each(lambda part: part.framed(columns, reach))

    def running_range(self, name: str, kind: str, column: Column) -> DataFrame:
        """As ``running``, but rows with equal sort values share the result."""
        return self._each(lambda part: part.running_range(name, kind, column))

    def ranks(self, rank: str, dense_rank: str) -> DataFrame:
        """``rank`` and ``dense_rank`` over the sort columns."""
        return self._each(lambda part: part.ranks(rank, dense_rank))

    def totals(self, name: str, aggregate: Column) -> DataFrame:
        """The aggregate over the whole key, on every row."""
        return self._each(lambda part: part.totals(name, aggregate))


def collect_chunks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    chunk_rows: int = 100_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """All values of a key in order, as arrays of at most ``chunk_rows`` elements.

    A key with no more values than that gives one row (chunk 0); a larger one gives
    several, so no array outgrows a task and no value is left out.
    """
    numbered = OrderedKeys(df, keys, order, rows_per_task).position(POSITION)
    chunk = whole_div(F.col(POSITION) - 1, chunk_rows)
    items = F.sort_array(F.collect_list(F.struct(POSITION, F.col(value).alias("v"))))
    return (
        numbered.withColumn("chunk", chunk)
        .groupBy(*keys, "chunk")
        .agg(F.transform(items, lambda s: s["v"]).alias("items"))
    )
