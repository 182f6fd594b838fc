"""Kafka options and payloads. The connector is a separate package on the cluster; what
can be decided without it (options, offsets, payload columns) is plain data here."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EARLIEST, LATEST = -2, -1
MAX_TOPIC_PARTITIONS = 100_000


def offsets_json(offsets: dict[tuple[str, int], int]) -> str:
    """``{"topic": {"0": 23}}``; -2 is earliest and -1 is latest."""
    nested: dict[str, dict[str, int]] = {}
    for (topic, part), offset in sorted(offsets.items()):
        nested.setdefault(topic, {})[str(part)] = offset
    return json.dumps(nested)


def starting_offsets(stored: DataFrame) -> str:
    """Stored offsets (topic, part, offset) as the start position, ``earliest`` if there
    are none. One row per topic partition, so the row count is checked and small."""
    rows = stored.select("topic", "part", "offset").limit(MAX_TOPIC_PARTITIONS + 1).collect()
    if len(rows) > MAX_TOPIC_PARTITIONS:
        raise ValueError(f"more than {MAX_TOPIC_PARTITIONS} topic partitions for one stream")
    return offsets_json({(r.topic, r.part): r.offset for r in rows}) if rows else "earliest"


def source_options(
    servers: str,
    topics: list[str] | None = None,
    pattern: str | None = None,
    assign: dict[str, list[int]] | None = None,
    starting: str = "latest",
    ending: str | None = None,
    max_offsets: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """``max_offsets`` caps the rate; ``min_partitions`` splits large topic partitions over
    several tasks."""
    chosen = [c for c in (topics, pattern, assign) if c]
    if len(chosen) != 1:
        raise ValueError("give exactly one of topics, pattern, assign")
    options = {"kafka.bootstrap.servers": servers, "startingOffsets": starting}
    if topics:
        options["subscribe"] = ",".join(topics)
    elif pattern:
        options["subscribePattern"] = pattern
    else:
        options["assign"] = json.dumps(assign)
    if ending is not None:
        options["endingOffsets"] = ending
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def read_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return decode(spark.readStream.format("kafka").options(**options).load())


def read_batch(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return decode(spark.read.format("kafka").options(**options).load())


def decode(messages: DataFrame) -> DataFrame:
    """Key and value as text; topic, partition, offset and timestamp stay."""
    return messages.withColumns(
        {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
    )


def payload(
    df: DataFrame, key: str | Column, columns: list[str], topic: str | Column | None = None
) -> DataFrame:
    """Key and JSON value; with ``topic`` a topic per row."""
    key = F.col(key) if isinstance(key, str) else key
    parts = [key.cast("string").alias("key"), F.to_json(F.struct(*columns)).alias("value")]
    if topic is not None:
        parts.append((F.lit(topic) if isinstance(topic, str) else topic).alias("topic"))
    return df.select(*parts)


def sink_options(servers: str, topic: str | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers}
    return {**options, "topic": topic} if topic else options
