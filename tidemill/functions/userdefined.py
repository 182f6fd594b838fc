"""User-defined functions, and the column forms that replace them at scale."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf, pandas_udf, udtf
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


@arrow_udf(T.StringType())
def first_two(text: pa.Array) -> pa.Array:
    """The first two characters."""
    return pc.utf8_slice_codeunits(text, 0, 2)


@pandas_udf(T.StringType())
def level_name(score: pd.Series) -> pd.Series:
    """Level of a score; the same ranges as ``plans.points.LEVELS``."""
    from tidemill.plans.points import LEVELS, TOP_LEVEL

    edges = [float("-inf"), *[b for b, _ in LEVELS], float("inf")]
    names = [*[n for _, n in LEVELS], TOP_LEVEL]
    return pd.cut(score, edges, right=False, labels=names).astype("object")


@pandas_udf(T.DoubleType())
def growth_of(period: pd.Series, amount: pd.Series) -> float:
    """(later - earlier) / earlier for two periods, as a grouped aggregate.

    Spark gives a whole group to one call: for checking ``growth``, not for large groups.
    """
    totals = amount.groupby(period).sum().sort_index()
    if len(totals) != 2 or totals.iloc[0] == 0:
        return float("nan")
    return float((totals.iloc[1] - totals.iloc[0]) / totals.iloc[0])


def growth(period: str | Column, amount: str | Column, earlier, later) -> Column:
    """Year-on-year growth as conditional sums, which combine map-side."""
    period = F.col(period) if isinstance(period, str) else period
    amount = F.col(amount) if isinstance(amount, str) else amount
    before = F.sum(F.when(period == earlier, amount))
    after = F.sum(F.when(period == later, amount))
    return F.try_divide(after - before, before)


@udtf(
    returnType=T.StructType(
        [T.StructField("word", T.StringType()), T.StructField("cnt", T.IntegerType())]
    )
)
class WordsOfCell:
    """Words of one ``|``-joined cell with their counts in that cell."""

    def eval(self, cell: str):
        counts: dict[str, int] = {}
        for word in (cell or "").split("|"):
            if word:
                counts[word] = counts.get(word, 0) + 1
        yield from counts.items()


@udtf
class RunsOf:
    """Runs of equal values in a partition's rows: ``runs_of(TABLE(...) PARTITION BY key ORDER BY
    ..., 'key', 'value', most)``. The result has the key's and the value's own types. State is one
    run; a partition of more than ``most`` rows is refused by its key, since one task has it all."""

    def __init__(self):
        self.rows, self.run, self.held = 0, 0, None

    @staticmethod
    def analyze(table: AnalyzeArgument, key: AnalyzeArgument, value: AnalyzeArgument, most: AnalyzeArgument):
        kinds = {f.name: f.dataType for f in table.dataType.fields}
        for name in (key.value, value.value):
            if name not in kinds:
                raise ValueError(f"runs_of: no column {name}")
        return AnalyzeResult(
            T.StructType()
            .add(key.value, kinds[key.value])
            .add("run", T.IntegerType())
            .add(value.value, kinds[value.value])
            .add("cnt", T.IntegerType())
        )

    def eval(self, row, key: str, value: str, most: int):
        self.rows += 1
        if self.rows > most:
            raise ValueError(f"runs_of: {key} {row[key]!r} has more than {most} rows")
        now = row[value]
        if self.held is None or self.held[2] != now:
            if self.held is not None:
                yield tuple(self.held)
            self.run += 1
            self.held = [row[key], self.run, now, 0]
        self.held[3] += 1

    def terminate(self):
        if self.held is not None:
            yield tuple(self.held)


def register(spark: SparkSession) -> None:
    """Make the functions callable from SQL text."""
    spark.udf.register("first_two", first_two)
    spark.udf.register("level_name", level_name)
    spark.udtf.register("words_of_cell", WordsOfCell)
    spark.udtf.register("runs_of", RunsOf)


def batch_counts(column: str):
    """Arrow-batch function that counts the values of ``column`` within each batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted = pc.value_counts(batch.column(column))
            yield pa.RecordBatch.from_arrays(
                [counted.field("values"), counted.field("counts")], [column, "cnt"]
            )

    return count


def count_by_batches(df: DataFrame, column: str) -> DataFrame:
    """Counts per value: per Arrow batch in Python, then added up by Spark."""
    partial = df.select(column).mapInArrow(batch_counts(column), f"{column} string, cnt bigint")
    return partial.groupBy(column).agg(F.sum("cnt").alias("cnt"))
