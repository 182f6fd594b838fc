"""JDBC tables. Reads are split into ranges so that executors read side by side;
writes go out per partition in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BATCH_ROWS = 10_000


def connection(url: str, table: str, user: str, password: str, driver: str) -> dict[str, str]:
    return {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Whole table in one partition: for small tables."""
    return spark.read.format("jdbc").options(**options).load()


def partitioning(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """Options that stride ``column``; rows outside the bounds go to the end partitions."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_partitioned(
    spark: SparkSession, options: dict[str, str], column: str, lower: int, upper: int, parts: int
) -> DataFrame:
    strides = partitioning(column, lower, upper, parts)
    return spark.read.format("jdbc").options(**options, **strides).load()


def range_predicates(column: str, lower: int, upper: int, partitions: int) -> list[str]:
    """Conditions that cover ``lower <= column <= upper`` once each; nothing outside is read."""
    length = upper - lower + 1
    edges = [lower + i * length // partitions for i in range(partitions + 1)]
    return [
        f"{column} >= {start} AND {column} <= {end - 1}"
        for start, end in zip(edges, edges[1:])
        if end > start
    ]


def read_between(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str],
) -> DataFrame:
    """One partition per range, inclusive bounds."""
    predicates = range_predicates(column, lower, upper, partitions)
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def append(df: DataFrame, options: dict[str, str], batch_rows: int = BATCH_ROWS) -> None:
    """One connection per partition, ``batch_rows`` rows per insert."""
    writer = df.write.format("jdbc").options(**options)
    writer.option("batchsize", str(batch_rows)).mode("append").save()
