"""Feature columns and stable splits."""

from __future__ import annotations

from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.sampling import hash_split

FEATURES = "features"


def assemble(df: DataFrame, columns: list[str], keep: list[str] = ()) -> DataFrame:
    assembler = VectorAssembler(inputCols=list(columns), outputCol=FEATURES)
    return assembler.transform(df).select(*keep, FEATURES)


def from_array(df: DataFrame, column: str, keep: list[str] = ()) -> DataFrame:
    vector = array_to_vector(F.col(column).cast("array<double>")).alias(FEATURES)
    return df.select(*keep, vector)


def split(
    df: DataFrame, keys: list[str], train: float = 0.8, seed: int = 11
) -> tuple[DataFrame, DataFrame]:
    """Train and test part by the hash of the key: the same in every run."""
    parts = hash_split(df, keys, [train, 1 - train], seed, "_part")
    return (
        parts.filter(F.col("_part") == 0).drop("_part"),
        parts.filter(F.col("_part") == 1).drop("_part"),
    )


def index_labels(df: DataFrame, column: str, name: str):
    """Frequency order, equal counts in alphabetical order; model and indexed frame. Rows
    without a value stay, without an index."""
    model = StringIndexer(
        inputCol=column, outputCol=name, stringOrderType="frequencyDesc", handleInvalid="keep"
    ).fit(df)
    known = F.when(F.col(name) < len(model.labels), F.col(name))
    return model, model.transform(df).withColumn(name, known)


def label_names(model, column: str, name: str) -> IndexToString:
    return IndexToString(inputCol=column, outputCol=name, labels=model.labels)
