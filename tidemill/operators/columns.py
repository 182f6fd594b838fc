"""Column-level operators that take more than one Spark call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.plans.bounds import checked_broadcast


def any_present(*columns: str) -> Column:
    """At least one of the columns is not NULL."""
    test = F.lit(False)
    for column in columns:
        test = test | F.col(column).isNotNull()
    return test


def recode(column: str, mapping: dict[str, float]) -> Column:
    """The mapped number, NULL for a value that is not listed."""
    chain = None
    for source, target in mapping.items():
        test = F.col(column) == F.lit(source)
        chain = F.when(test, F.lit(target)) if chain is None else chain.when(test, F.lit(target))
    return chain


def lookup(
    df: DataFrame, rules: DataFrame, on: str, value: str, default, name: str | None = None
) -> DataFrame:
    """``rules.getOrElse(key, default)``: a left join whose right side is broadcast when
    it is measured to fit."""
    joined = df.join(checked_broadcast(rules), on, "left")
    filled = F.coalesce(F.col(value), F.lit(default))
    return joined.withColumn(name or value, filled)


def levels(column: str | Column, bounds: list[tuple[float, str]], top: str) -> Column:
    """Half-open ranges: the label of the first bound above the value, else ``top``; NULL has
    no level."""
    score = F.col(column) if isinstance(column, str) else column
    chain = F.when(score.isNull(), F.lit(None).cast("string"))
    for bound, label in bounds:
        chain = chain.when(score < bound, label)
    return chain.otherwise(top)
