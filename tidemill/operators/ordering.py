"""Index and custom order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans.ordered import ROWS_PER_TASK, OrderedKeys


def zip_with_index(
    df: DataFrame, order: list[str], name: str = "index", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """0-based index over a unique sort key. A frame larger than ``rows_per_task`` is
    numbered block by block, never in one task."""
    numbered = OrderedKeys(df, [], order, rows_per_task).position(name)
    return numbered.withColumn(name, F.col(name) - 1)


def listed_order(column: str, values: list[str]) -> Column:
    """Sort key that follows ``values``; anything else comes last."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return F.when(place > 0, place).otherwise(len(values) + 1).cast("int")
