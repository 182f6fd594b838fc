"""Counts, windows and custom state over streams.

The aggregates combine map-side, so a hot key reaches the state store as one row per
task and batch.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemill.plans.skew import SALT
from tidemill.session import STATE_PARTITIONS
from tidemill.streaming import intervals

BLOCK = 10_000


def running_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))


def windowed(
    df: DataFrame,
    moment: str,
    length: str,
    slide: str | None,
    aggregates: list[Column],
    keys: list[str] = (),
) -> DataFrame:
    """Aggregates per time window (and key); the window's start as a zone-less time."""
    window = F.window(moment, length, slide) if slide else F.window(moment, length)
    grouped = df.groupBy(window.alias("_window"), *keys).agg(*aggregates)
    names = [c for c in grouped.columns if c not in ("_window", *keys)]
    start = F.col("_window.start").cast("timestamp_ntz").alias("start")
    return grouped.select(start, *keys, *names)


def _sums(table: pa.Table, keys: list[str]) -> pa.Table:
    added = table.group_by(keys).aggregate([("cnt", "sum"), ("total", "sum")])
    return added.rename_columns([c.removesuffix("_sum") for c in added.column_names])


def _packed(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def _parts(most: int):
    """Rows ``bucket, key, cnt, total`` of a task added up, one cell of sums per bucket."""

    def cells(held: pa.Table) -> pa.RecordBatch:
        held = held.combine_chunks().sort_by("bucket")
        places = held["bucket"].to_numpy()
        starts = np.flatnonzero(np.r_[True, np.diff(places) != 0])
        sums = held.select(["key", "cnt", "total"])
        packed = [_packed(sums.slice(a, b - a)) for a, b in zip(starts, np.r_[starts[1:], len(places)])]
        return pa.RecordBatch.from_arrays(
            [pa.array(places[starts], pa.int32()), pa.array(packed, pa.binary())], ["bucket", "part"]
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = _sums(pa.Table.from_batches([batch]), ["bucket", "key"])
            held = now if held is None else _sums(pa.concat_tables([held, now]), ["bucket", "key"])
            if held.num_rows > most:
                yield cells(held)
                held = None
        if held is not None:
            yield cells(held)

    return task


def running_totals(df: DataFrame, key: str, value: str, buckets: int = 512, most: int = 200_000) -> DataFrame:
    """Running count and sum per key, kept by the function itself; ``merged_totals`` takes them.

    Rows are added up in the task that reads them, ``most`` keys at a time, so a hot key reaches
    the state as a row or two per task. A call of the function costs milliseconds, so a state holds
    a bucket of keys (column SALT; all of a key are in one), and a call adds a whole bucket up."""

    def update(
        group: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        came = [pa.ipc.open_stream(part).read_all() for frame in frames for part in frame["part"]]
        new = _sums(pa.concat_tables(came), ["key"])
        whole = new
        if state.exists:
            whole = _sums(pa.concat_tables([pa.ipc.open_stream(state.get[0]).read_all(), new]), ["key"])
        state.update((_packed(whole),))
        changed = whole.filter(pc.is_in(whole["key"], new["key"].combine_chunks()))
        out = changed.to_pandas(integer_object_nulls=True)
        out.insert(1, SALT, group[0])
        yield out

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(key).alias("key"),
        F.lit(1).cast("bigint").alias("cnt"),
        F.coalesce(F.col(value).cast("bigint"), F.lit(0).cast("bigint")).alias("total"),
    )
    parts = rows.mapInArrow(_parts(most), "bucket int, part binary")
    totals = parts.groupBy("bucket").applyInPandasWithState(
        update,
        f"key {kind}, {SALT} int, cnt bigint, total bigint",
        "sums binary",
        "update",
        GroupStateTimeout.NoTimeout,
    )
    return totals.withColumnRenamed("key", key)


def merged_totals(states: DataFrame, key: str) -> DataFrame:
    """The last state of each (key, salt), added up per key."""
    return states.groupBy(key).agg(F.sum("cnt").alias("cnt"), F.sum("total").alias("total"))


def _firsts(keys: list[str], moment: str | None, most_rows: int, most_bytes: int):
    """The first row of each key among the rows that a task has at hand, or the latest by ``moment``."""

    def firsts(rows: pa.Table) -> list[pa.RecordBatch]:
        if moment:
            rows = rows.take(pc.sort_indices(rows, [(moment, "descending")], null_placement="at_end"))
        place = pa.array(np.arange(rows.num_rows))
        named = pa.table([rows[k] for k in keys] + [place], names=[*map(str, range(len(keys))), "place"])
        kept = named.group_by([*map(str, range(len(keys)))]).aggregate([("place", "min")])["place_min"]
        if len(kept) < rows.num_rows:
            rows = rows.take(kept.combine_chunks().sort())
        return rows.combine_chunks().to_batches(max_chunksize=BLOCK)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            count, size = count + batch.num_rows, size + batch.nbytes
            if count >= most_rows or size >= most_bytes:
                yield from firsts(pa.Table.from_batches(held))
                held, count, size = [], 0, 0
        if count:
            yield from firsts(pa.Table.from_batches(held))

    return task


def unique(
    df: DataFrame,
    keys: list[str],
    moment: str | None = None,
    most_rows: int = 200_000,
    most_bytes: int = 64 * 1024 * 1024,
) -> DataFrame:
    """One row per key. Either the watermark column is one of the keys, or it is ``moment`` and
    copies count as such only within the watermark's delay.

    A stream does not drop copies before its shuffle, so a task drops those among the rows it has
    at hand (``most_rows`` or ``most_bytes``): a key with any number of copies reaches its state
    as a row for each of these portions. Of copies with other times the latest goes on, for an
    earlier one may be too late for the watermark. Keys are plain values, no arrays or structs."""
    firsts = _firsts(keys, moment, most_rows, most_bytes)
    fewer = df.mapInArrow(firsts, df.schema)  # the schema names the watermark as well
    return fewer.dropDuplicatesWithinWatermark(keys) if moment else fewer.dropDuplicates(keys)


def _bucket(moment: Column, size: int) -> Column:
    return F.floor(F.unix_date(moment.cast("date")) / F.lit(size))


def _reach(df: DataFrame, moment: str, days: int) -> DataFrame:
    """A copy of each row per bucket of days that ``days`` from its time on can touch."""
    size = max(1, days // 2)
    last = F.date_add(F.col(moment).cast("date"), days)
    buckets = F.sequence(_bucket(F.col(moment), size), _bucket(last, size))
    return df.withColumn("_bucket", F.explode(buckets))


def _within(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, days: int, how: str):
    """Join of the copies of ``_reach`` with right rows, each of which has one bucket."""
    other = right.withColumn("_right_bucket", _bucket(F.col(right_time), max(1, days // 2)))
    span = F.expr(f"INTERVAL '{days}' DAY")
    return left.join(
        other.withColumnRenamed(key, "_key"),
        (F.col(key) == F.col("_key"))
        & (F.col("_bucket") == F.col("_right_bucket"))
        & (F.col(right_time) >= F.col(left_time))
        & (F.col(right_time) <= F.col(left_time) + span),
        how,
    )


KEY_BUCKETS = 16


def key_buckets(spark: SparkSession, each: int = 8) -> int:
    """Buckets of keys for the state of a join: so many for each partition of the state."""
    cores = spark.sparkContext.defaultParallelism
    return each * int(spark.conf.get(STATE_PARTITIONS, str(cores)))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    days: int,
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """Rows with equal keys and ``left_time <= right_time <= left_time + days``.

    The day span is cut into buckets that join the key, so that a hot key is spread over
    time: a right row has one bucket, a left row one copy per bucket it can reach. Two streams
    keep a state per bucket of time and of keys (``intervals``); the number of the latter stays
    with the checkpoint. Rows later than the watermark take no part.
    """
    if intervals.fits(left, right, key, left_time, right_time):
        return intervals.join(left, right, key, left_time, right_time, days, False, buckets)
    copies = _reach(left, left_time, days)
    joined = _within(copies, right, key, left_time, right_time, days, "inner")
    return joined.drop("_bucket", "_right_bucket", "_key")


def outer_interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    days: int,
    buckets: int = KEY_BUCKETS,
) -> DataFrame:
    """Left outer form; a left row without a match comes out once the watermark has
    passed its interval. Two streams keep one state for matches and for missing matches
    (``intervals``). What follows is the form for other frames, with two joins.

    Each copy of a left row reports when it stayed alone, so a hot key is spread over time
    here as well. A second state notes per left row which of its copies have reported: a row
    is without a match when all have, and equal rows come out as often as they came in.
    The side that only asks for a match holds keys and times of the right rows, no more.
    A left row without a time has no interval and comes out never; one without a key does.
    """
    if intervals.fits(left, right, key, left_time, right_time, True):
        return intervals.join(left, right, key, left_time, right_time, days, True, buckets)
    size = max(1, days // 2)
    last = F.date_add(F.col(left_time).cast("date"), days)
    copies = (_bucket(last, size) - _bucket(F.col(left_time), size) + 1).cast("int")
    asked = _within(
        _reach(left, left_time, days), right.select(key, right_time), key, left_time, right_time, days, "left_outer"
    )
    place = (F.col("_bucket") - _bucket(F.col(left_time), size)).cast("int").alias("_place")
    reports = asked.where(F.col("_right_bucket").isNull()).select(*left.columns, place)
    alone = reports.groupBy(*left.columns).agg(
        F.count(F.lit(1)).alias("_reports"), F.bit_or(F.expr("shiftleft(1, _place)")).alias("_places")
    )
    every = alone.withColumn("_copies", copies).where("_places = shiftleft(1, _copies) - 1")
    times = every.selectExpr("*", "_reports div _copies as _times")
    # in two steps, so that no array is long when one row came very often
    blocks = times.selectExpr("*", f"explode(sequence(0, _times div {BLOCK})) as _block")
    settled = blocks.selectExpr(
        "*", f"explode(array_repeat(0, int(least({BLOCK}, _times - _block * {BLOCK})))) as _again"
    )
    matched = interval_join(left, right, key, left_time, right_time, days)
    return matched.unionByName(settled.select(*left.columns), allowMissingColumns=True)
