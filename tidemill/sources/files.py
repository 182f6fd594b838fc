"""File and in-memory sources. Schemas are declared; inference is an ingest helper."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# fixed values: text formats that keep microseconds
MICROS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def as_struct(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_csv(
    spark: SparkSession, path: str, schema, header: bool = True, sep: str = ",", **options
) -> DataFrame:
    return spark.read.schema(schema).options(**{**MICROS, **options}).csv(path, header=header, sep=sep)


def read_csv_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """One extra pass over the files to guess the types."""
    return spark.read.csv(path, header=True, inferSchema=True, sep=sep)


def read_csv_positional(
    spark: SparkSession, path: str, schema, header: bool = False, sep: str = ","
) -> DataFrame:
    """All columns as text, then cast by position; text that does not fit becomes NULL."""
    target = as_struct(schema)
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in target.fields])
    return typed(spark.read.schema(texts).csv(path, header=header, sep=sep), target)


def _parsed(field: T.StructField, formats: dict[str, str]) -> Column:
    if field.name in formats:
        return F.try_to_timestamp(field.name, F.lit(formats[field.name])).cast(field.dataType)
    return F.col(field.name).try_cast(field.dataType)


def typed(texts: DataFrame, schema, formats: dict[str, str] = {}) -> DataFrame:
    """Text columns as the types of ``schema``; text that does not fit becomes NULL. ``formats``
    has the time patterns of columns that are not written as ISO times."""
    return texts.select(*[_parsed(f, formats).alias(f.name) for f in as_struct(schema).fields])


def _faults(schema, formats: dict[str, str]) -> list[tuple[str, Column]]:
    return [
        (f.name, F.col(f.name).isNotNull() & _parsed(f, formats).isNull())
        for f in as_struct(schema).fields
    ]


def reject_counts(texts: DataFrame, schema, formats: dict[str, str] = {}) -> DataFrame:
    """``column, present, rejected`` per column: how many texts there are, and how many of them
    ``typed`` makes NULL. One pass and one row per task, however many columns there are."""
    faults = _faults(schema, formats)
    counts = [
        F.struct(
            F.lit(name).alias("column"),
            F.count(name).alias("present"),
            F.count_if(fault).alias("rejected"),
        )
        for name, fault in faults
    ]
    return texts.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def rejected_rows(texts: DataFrame, schema, formats: dict[str, str] = {}) -> DataFrame:
    """The rows with a text that ``typed`` makes NULL, as they were read, and ``faults``, the
    names of those columns; for a place where they can be mended and read again."""
    names = F.array(*[F.when(fault, F.lit(name)) for name, fault in _faults(schema, formats)])
    return texts.withColumn("faults", F.array_compact(names)).where(F.size("faults") > 0)


def read_json(spark: SparkSession, path: str, schema, multiline: bool = False) -> DataFrame:
    return spark.read.schema(schema).options(**MICROS).json(path, multiLine=multiline)


def read_delimited_text(
    spark: SparkSession, path: str, schema, separator: str = r"\s+"
) -> DataFrame:
    """Lines split by a regular expression, cast by position."""
    fields = F.split(F.trim("value"), separator)
    return spark.read.text(path).select(
        *[
            F.get(fields, F.lit(i)).try_cast(f.dataType).alias(f.name)
            for i, f in enumerate(as_struct(schema).fields)
        ]
    )


def read_any(spark: SparkSession, fmt: str, path: str, schema=None, **options) -> DataFrame:
    """The generic ``format().load()``: parquet, orc, text, csv, json."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def rows_with_schema(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)
