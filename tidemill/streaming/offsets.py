"""Offset bookkeeping as table jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.sinks.keyed import latest_per_key, write_batch


def latest_offsets(log: DataFrame) -> DataFrame:
    """Newest entry per (grp, topic, part) of an append-only log; of two with the same
    time the larger offset."""
    newest = latest_per_key(log.select("grp", "topic", "part", "offset", "ts"),
                            ["grp", "topic", "part"], ["ts", "offset"])
    return newest.select("grp", "topic", "part", "offset")


def clamp(stored: DataFrame, bounds: DataFrame) -> DataFrame:
    """Start offsets inside [low, high]. Partitions come from ``bounds``; one that has no
    stored offset starts at ``low``, a stored one that is not in ``bounds`` is dropped."""
    joined = bounds.join(stored.select("topic", "part", "offset"), ["topic", "part"], "left")
    kept = F.least("high", F.coalesce("offset", F.lit(0)))
    return joined.select("topic", "part", F.greatest("low", kept).alias("start_offset"))


def save_offsets(offsets: DataFrame, batch_id: int, path: str) -> None:
    """Append one batch's (grp, topic, part, offset, ts) to the log, once."""
    write_batch(offsets, batch_id, path)
