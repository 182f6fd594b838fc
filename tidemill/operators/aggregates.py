"""Aggregates that take more than one Spark call. All of them combine map-side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def two_level(
    df: DataFrame,
    keys: list[str],
    part: str,
    inside: Callable[[str], Column],
    across: Callable[[str], Column],
    value: str,
    name: str,
) -> DataFrame:
    """One function inside each part of a key, another across its parts."""
    return (
        df.groupBy(*keys, part).agg(inside(value).alias("_v")).groupBy(*keys).agg(
            across("_v").alias(name)
        )
    )


def integer_mean(value: str, zero: int = 0) -> Column:
    """``sum div count``, cut towards zero; ``zero`` when there is no row."""
    mean = F.expr(f"sum(`{value}`) div nullif(count(`{value}`), 0)")
    return F.coalesce(mean, F.lit(zero).cast("bigint"))


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row that sorts first within its key; a ``min`` over structs, no window."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    ordered = [o for o in order if o not in keys]
    row = F.min(F.struct(*ordered, *rest)).alias("_row")
    picked = df.groupBy(*keys).agg(row).select(*keys, "_row.*")
    return picked.select(*df.columns)


def item_sets(df: DataFrame, key: str, item: str, name: str = "items") -> DataFrame:
    """Sorted set of items per key. Repeats are dropped before the sets are built, so an
    array is never longer than the number of different items."""
    pairs = df.select(key, item).distinct()
    return pairs.groupBy(key).agg(F.sort_array(F.collect_set(item)).alias(name))


def observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` that counts while it runs; read the result after an action."""
    observation = Observation()
    return df.observe(observation, *[c.alias(n) for n, c in metrics.items()]), observation
