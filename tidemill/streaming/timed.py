"""Keyed state with timers: sessions that close by event time, and sliding windows from panes.

Both add rows up in the task that reads them, before the shuffle, so that a hot key reaches the
state as a few rows per task; both settle by the watermark: a timer per key fires once it has
passed, sends out what is final and drops it from the state. What is open is a snapshot, which
``snapshot`` reads from a checkpoint as a table, after any batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

MILLI = 1_000  # microseconds
SECOND = 1_000_000
SESSION = "key bigint, start bigint, stop bigint, cnt bigint, total bigint"
COLUMNS = ("key", "start", "stop", "cnt", "total")


def stretches(gap: int, key, start, stop, cnt, total) -> tuple[np.ndarray, ...]:
    """Parts of several keys in arrays: those of a key no further apart than ``gap`` become one."""
    order = np.lexsort((start, key))
    key, start, stop, cnt, total = (np.asarray(c)[order] for c in (key, start, stop, cnt, total))
    new = np.r_[True, key[1:] != key[:-1]]
    # the latest stop so far of the same key: a later key's ranks are above all of an earlier one's
    moments, rank = np.unique(stop, return_inverse=True)
    above = (np.cumsum(new) - 1) * len(moments)
    latest = moments[np.maximum.accumulate(rank + above) - above]
    new[1:] |= start[1:] > latest[:-1] + gap
    first = np.flatnonzero(new)
    sums = [np.add.reduceat(c, first) for c in (cnt, total)]
    return key[first], start[first], np.maximum.reduceat(stop, first), *sums


def merged(parts: list[tuple]) -> list[tuple]:
    """Tuples (start, stop, gap, cnt, total) of one key: those no further apart than ``gap`` become one."""
    if not parts:
        return []
    start, stop, (gap, *_), cnt, total = zip(*parts)
    _, start, stop, cnt, total = (c.tolist() for c in stretches(gap, [0] * len(parts), start, stop, cnt, total))
    return list(zip(start, stop, [gap] * len(start), cnt, total))


def _stretches(gap: int, most: int):
    """Stretches without a pause longer than ``gap`` of each key, among the rows that a task has at
    hand, ``most`` at a time."""

    def told(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        bucket, key, at, amount = (c.to_numpy() for c in pa.Table.from_batches(batches).columns)
        found = stretches(gap, key, at, at, np.ones(len(at), np.int64), amount)
        keys, place = np.unique(key, return_index=True)
        own = bucket[place[np.searchsorted(keys, found[0])]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (own, *found)], ["bucket", *COLUMNS])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= most:
                yield told(held)
                held, count = [], 0
        if count:
            yield told(held)

    return task


def _sessions_in(part: bytes) -> list[np.ndarray]:
    return [c.to_numpy() for c in pa.ipc.open_stream(part).read_all().columns]


class Sessions(StatefulProcessor):
    """State per bucket of keys: the open sessions of all its keys in one cell of Arrow, so a call
    takes them and gives them back at once. Parts may come in any order; a session ends when
    the watermark is ``gap`` past its last moment."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "part binary")

    def _ends(self, stop: np.ndarray) -> np.ndarray:
        return -(-(stop + self.gap) // MILLI)

    def _keep(self, columns, after: int = -1) -> None:
        """Hold these; a timer fires when the watermark is above it, and the next one is later than ``after``."""
        table = pa.table([pa.array(c) for c in columns], list(COLUMNS))
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table)
        self.open.update((out.getvalue().to_pybytes(),))
        self.handle.registerTimer(max(int(self._ends(columns[2]).min()) - 1, after + 1))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        parts = [[frame[c].to_numpy() for c in COLUMNS] for frame in rows if len(frame)]
        if self.open.exists():
            parts.append(_sessions_in(self.open.get()[0]))
        if parts:
            self._keep(stretches(self.gap, *(np.concatenate(c) for c in zip(*parts))))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """All sessions that the watermark ends. A timer of a session that went on since then, or
        was ended by another timer, finds none."""
        if not self.open.exists():
            return
        columns = _sessions_in(self.open.get()[0])
        done = self._ends(columns[2]) <= timerValues.getCurrentWatermarkInMs()
        if done.all():
            self.open.clear()
        else:
            self._keep([c[~done] for c in columns], expiredTimerInfo.getExpiryTimeInMs())
        if done.any():
            yield pd.DataFrame(dict(zip(COLUMNS, (c[done] for c in columns))))


def _by_value(call):
    """Processors go with their code: the process that reads their state schema has no package."""
    module = sys.modules[__name__]
    cloudpickle.register_pickle_by_value(module)
    try:
        return call()
    finally:
        cloudpickle.unregister_pickle_by_value(module)


def sessions(
    df: DataFrame, key: str, moment: str, amount: Column, gap_seconds: int, delay: str, buckets: int = 16, most: int = 200_000
) -> DataFrame:
    """Closed sessions of each key: ``key, start, stop`` (zone-less) ``cnt, total``. A row may come
    ``delay`` late. The number of ``buckets`` of keys, which are the states, stays with the checkpoint."""
    gap = gap_seconds * SECOND
    rows = df.select(
        F.pmod(F.xxhash64(F.col(key).cast("bigint")), F.lit(buckets)).cast("int").alias("bucket"),
        F.col(key).cast("bigint").alias("key"),
        F.unix_micros(F.col(moment).cast("timestamp")).alias("at"),
        F.coalesce(amount.cast("bigint"), F.lit(0)).alias("amount"),
    ).where("key is not null and at is not null")
    parts = rows.mapInArrow(_stretches(gap, most), f"bucket int, {SESSION}")
    timed = parts.withColumn("moment", F.timestamp_micros("stop")).withWatermark("moment", delay)
    closed = _by_value(
        lambda: timed.groupBy("bucket").transformWithStateInPandas(Sessions(gap), SESSION, "append", "EventTime")
    )
    return closed.withColumns({c: zoneless(c) for c in ("start", "stop")})


def zoneless(micros: str) -> Column:
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def snapshot(
    spark: SparkSession, checkpoint: str, name: str, batch_id: int | None = None
) -> DataFrame:
    """State ``name`` of a checkpoint's stateful operator as a table, one row per entry: the key's
    and the entry's columns; of sessions, which stand in cells, a row per session. As it is after
    ``batch_id``, or after the last batch."""
    reader = spark.read.format("statestore").option("stateVarName", name)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    found = reader.load(checkpoint)
    if "user_map_key" in found.columns:
        return found.select("key.*", "user_map_key.*", "user_map_value.*")
    return found.select("value.part").mapInArrow(_cells_opened, SESSION)


def _cells_opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in batch["part"].to_pylist():
            yield from pa.ipc.open_stream(part)


class Slide:
    """Sums and maxima of a window that moves on pane by pane. The sum takes a pane in and the
    oldest off again. A maximum has no inverse, so panes stand in two stacks, each with the
    maximum of what is below: panes come in on one, leave from the other, and the first is
    turned over when the other is empty; a pane is touched three times at most."""

    def __init__(self):
        self.cnt = self.total = 0
        self.back: list[tuple] = []  # (slot, cnt, total, highest) as they came
        self.back_high = None
        self.front: list[tuple] = []  # (pane, highest of it and all later ones in this stack)

    def push(self, pane: tuple) -> None:
        self.cnt += pane[1]
        self.total += pane[2]
        self.back.append(pane)
        self.back_high = pane[3] if self.back_high is None else max(self.back_high, pane[3])

    def _turn(self) -> None:
        if not self.front:
            high = None
            while self.back:
                pane = self.back.pop()
                high = pane[3] if high is None else max(high, pane[3])
                self.front.append((pane, high))
            self.back_high = None

    def oldest(self) -> int | None:
        self._turn()
        return self.front[-1][0][0] if self.front else None

    def pop(self) -> None:
        self._turn()
        pane, _ = self.front.pop()
        self.cnt -= pane[1]
        self.total -= pane[2]

    def highest(self):
        return max(x for x in (self.back_high, self.front[-1][1] if self.front else None) if x is not None)


def slide(panes: list[tuple], first: int, last: int, width: int) -> tuple[list[tuple], int]:
    """The windows that begin at slots ``first`` to ``last`` and hold a pane, as (slot, cnt, total,
    highest), and the slot after the last. ``panes`` are ascending; a window is ``width`` slots."""
    window, out, at = Slide(), [], 0
    start = first
    while start <= last:
        while at < len(panes) and panes[at][0] < start + width:
            if panes[at][0] >= start:
                window.push(panes[at])
            at += 1
        while (old := window.oldest()) is not None and old < start:
            window.pop()
        if window.oldest() is None:
            if at == len(panes):
                break
            start = max(start + 1, panes[at][0] - width + 1)  # nothing before the next pane
            continue
        out.append((start, window.cnt, window.total, window.highest()))
        start += 1
    return out, last + 1


def _panes(slot: int):
    """Per key and batch of rows one row per slot."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pa.Table.from_batches([batch]).to_pandas()
            frame["slot"] = np.floor_divide(frame["at"], slot)
            parts = frame.groupby(["key", "slot"], as_index=False).agg(
                cnt=("at", "size"), total=("amount", "sum"), highest=("amount", "max")
            )
            yield pa.RecordBatch.from_pandas(parts, preserve_index=False)

    return task


PANE = "key string, slot bigint, cnt bigint, total bigint, highest bigint"


class Panes(StatefulProcessor):
    """State per key: a map from the slot to (rows, total, highest) for the slots that a window
    which is not sent yet may hold, and the first window that is not sent. A window is sent
    when the watermark has passed its end."""

    def __init__(self, slot: int, width: int):
        self.slot, self.width = slot, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "slot bigint", "cnt bigint, total bigint, highest bigint")
        self.next = handle.getValueState("next", "slot bigint")

    def _due(self, window: int) -> int:
        """When the window that begins at a slot has ended, in milliseconds."""
        return -(-(window + self.width) * self.slot // MILLI)

    def _wait(self, first_pane: int) -> None:
        start = first_pane - self.width + 1
        if self.next.exists():
            start = max(start, self.next.get()[0])
        self.handle.registerTimer(self._due(start))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            least = None
            names = ("slot", "cnt", "total", "highest")
            for slot, cnt, total, highest in zip(*(frame[n].tolist() for n in names)):
                was = self.panes.getValue((slot,))
                if was is not None:
                    cnt, total, highest = cnt + was[0], total + was[1], max(highest, was[2])
                self.panes.updateValue((slot,), (cnt, total, highest))
                least = slot if least is None else min(least, slot)
            if least is not None:
                self._wait(least)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        panes = sorted((s[0], *v) for s, v in self.panes.iterator())
        if not panes:
            return
        now = timerValues.getCurrentWatermarkInMs() * MILLI
        last = now // self.slot - self.width  # the last window that has ended
        first = panes[0][0] - self.width + 1
        if self.next.exists():
            first = max(first, self.next.get()[0])
        if last < first:
            return
        done, after = slide(panes, first, last, self.width)
        self.next.update((after,))
        left = [pane[0] for pane in panes if pane[0] >= after]
        for pane in panes:
            if pane[0] < after:
                self.panes.removeKey((pane[0],))
        if left:
            self._wait(left[0])
        if done:
            out = pd.DataFrame(done, columns=["slot", "cnt", "total", "highest"])
            out.insert(0, "key", [key[0]] * len(done))
            yield out


def paned_windows(
    df: DataFrame,
    moment: str,
    amount: Column,
    length_seconds: int,
    slide_seconds: int,
    delay: str,
    key: str | None = None,
) -> DataFrame:
    """``key, start, cnt, total, highest`` of every window that holds a row, once the watermark has
    passed its end. The watermark follows the starts of slots, and a row later than ``delay``
    is left out. Without ``key`` all rows are one, with key ''."""
    if length_seconds % slide_seconds:
        raise ValueError("a window must be a whole number of slides")
    slot = slide_seconds * SECOND
    rows = df.select(
        (F.col(key).cast("string") if key else F.lit("")).alias("key"),
        F.unix_micros(F.col(moment).cast("timestamp")).alias("at"),
        F.coalesce(amount.cast("bigint"), F.lit(0)).alias("amount"),
    ).where("key is not null and at is not null")
    panes = rows.mapInArrow(_panes(slot), PANE)
    begun = panes.withColumn("moment", F.timestamp_micros(F.col("slot") * slot))
    processor = Panes(slot, length_seconds // slide_seconds)
    done = _by_value(
        lambda: begun.withWatermark("moment", delay)
        .groupBy("key")
        .transformWithStateInPandas(processor, PANE, "append", "EventTime")
    )
    return done.select(
        "key", F.timestamp_micros(F.col("slot") * slot).cast("timestamp_ntz").alias("start"),
        "cnt", "total", "highest",
    )
