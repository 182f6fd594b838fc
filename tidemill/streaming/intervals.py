"""Interval joins of two streams. A state holds the rows of a bucket of keys and a span of time.

Rows come to their state as Arrow cells, and a call of the function joins a whole cell by arrays, so
a batch costs a call per state it touches and no step per row. The spans join the key: a hot key is
spread over time, as a right row has one span and a left row a copy in each span that it can reach."""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

DAY = 86_400_000_000  # microseconds
BLOCK = 65_536
MOST_ROWS, MOST_BYTES = 500_000, 64 * 1024 * 1024
LEFT, RIGHT = 0, 1
MATCHED, ALONE = 0, 1
# types whose values are equal when their bytes are
EXACT = (T.IntegralType, T.StringType, T.BinaryType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
PLAIN = (*EXACT, T.FractionalType)


DELAY = "spark.watermarkDelayMs"  # Spark's name for a column's watermark


def fits(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, outer: bool = False
) -> bool:
    """Both are streams with a watermark, and their rows can be told apart here: the keys by their
    bytes and, where left rows come out alone, all of a left row by plain values."""
    kinds = [df.schema[key].dataType for df in (left, right)]
    return (
        left.isStreaming
        and right.isStreaming
        and DELAY in left.schema[left_time].metadata
        and DELAY in right.schema[right_time].metadata
        and kinds[0] == kinds[1]
        and isinstance(kinds[0], EXACT)
        and set(left.columns) & set(right.columns) == {key}
        and (not outer or all(isinstance(f.dataType, PLAIN) for f in left.schema.fields))
    )


def _packed(table: pa.Table) -> bytes:
    out = io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def _unpacked(part: bytes) -> pa.Table:
    return pa.ipc.open_stream(part).read_all()


def _edges(*columns: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where runs of equal values begin and end."""
    if len(columns[0]):
        new = np.flatnonzero(np.logical_or.reduce([np.diff(c) != 0 for c in columns])) + 1
        yield from zip(np.r_[0, new].tolist(), np.r_[new, len(columns[0])].tolist())


def _cells(side: int, size: int, span: int, most_rows: int, most_bytes: int):
    """Rows ``_bucket, _at, ...`` of a task as cells of Arrow, one per bucket of keys and span of time."""

    def cells(held: pa.Table) -> pa.RecordBatch:
        held = held.combine_chunks()
        at, bucket = held["_at"].to_numpy(), held["_bucket"].to_numpy()
        rows, place = np.arange(len(at)), at // size
        if side == LEFT:
            last = (at + span) // size  # the next span at most, as none is shorter than ``span``
            again = np.flatnonzero(last > place)
            rows, place = np.r_[rows, again], np.r_[place, last[again]]
        order = np.lexsort((place, bucket[rows]))
        rows, place = rows[order], place[order]
        bucket, dealt = bucket[rows], held.drop_columns(["_bucket"]).take(rows)
        edges = list(_edges(bucket, place))
        first = [low for low, _ in edges]
        parts = [_packed(dealt.slice(low, high - low)) for low, high in edges]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(bucket[first], pa.int32()),
                pa.array(place[first], pa.int64()),
                pa.array(np.full(len(first), side, np.int32)),
                pa.array(parts, pa.binary()),
                pa.array(np.maximum.reduceat(at[rows], first)).cast(pa.timestamp("us", "UTC")),
            ],
            ["bucket", "place", "side", "part", "moment"],
        )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, size_ = [], 0, 0
        for batch in batches:
            held.append(batch)
            count, size_ = count + batch.num_rows, size_ + batch.nbytes
            if count >= most_rows or size_ >= most_bytes:
                yield cells(pa.Table.from_batches(held))
                held, count, size_ = [], 0, 0
        if count:
            yield cells(pa.Table.from_batches(held))

    return task


def _codes(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """The keys of both sides as numbers, NULL as -1."""
    both = pa.chunked_array([*left["_key"].chunks, *right["_key"].chunks], left["_key"].type)
    codes = both.combine_chunks().dictionary_encode().indices.fill_null(-1)
    codes = codes.to_numpy(zero_copy_only=False).astype(np.int64)
    return codes[: left.num_rows], codes[left.num_rows :]


def meetings(
    left: np.ndarray, begin: np.ndarray, right: np.ndarray, at: np.ndarray, span: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For keys ``left`` with times ``begin`` and keys ``right`` with times ``at``: an order of the right
    rows, and for each left row where the rows that it meets begin and end in that order."""
    times, rank = np.unique(at, return_inverse=True)
    wide = len(times) + 1
    where = right * wide + rank
    order = np.argsort(where, kind="stable")
    where = where[order]
    low = np.searchsorted(where, left * wide + np.searchsorted(times, begin, "left"))
    high = np.searchsorted(where, left * wide + np.searchsorted(times, begin + span, "right"))
    return order, low, high


def _pairs(order: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Left and right row numbers of all pairs, a block at a time."""
    counts = high - low
    ends = np.cumsum(counts)
    for first in range(0, int(ends[-1]) if len(ends) else 0, BLOCK):
        pair = np.arange(first, min(first + BLOCK, int(ends[-1])))
        own = np.searchsorted(ends, pair, "right")
        yield own, order[low[own] + pair - (ends - counts)[own]]


def _joined(size: int, span: int, outer: bool):
    """The function that keeps a state: the left and the right rows that may still meet, as cells."""

    def rows(old: bytes | None, came: list[bytes], mark: int) -> tuple[pa.Table | None, int]:
        """What was held and what came in time, and how many of them were held."""
        held = [] if old is None else [_unpacked(old)]
        count = sum(table.num_rows for table in held)
        for part in came:
            new = _unpacked(part)
            new = new.filter(pc.greater(new["_at"], mark))
            held.append(new.append_column("_met", pa.array(np.zeros(new.num_rows, bool))))
        return (pa.concat_tables(held) if held else None), count

    def update(group: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        bucket, place = group
        came = {LEFT: [], RIGHT: []}
        for frame in frames:
            for side, part in zip(frame["side"], frame["part"]):
                came[side].append(part)
        mark_ms = state.getCurrentWatermarkMs()
        mark = mark_ms * 1000
        olds = state.get if state.exists else (None, None)
        left, left_old = rows(olds[0], came[LEFT], mark)
        right, right_old = rows(olds[1], came[RIGHT], mark)

        def told(kind: int, home: int, table: pa.Table) -> pd.DataFrame:
            return pd.DataFrame({"kind": [kind], "key_bucket": [bucket], "first": [home], "cell": [_packed(table)]})

        if left is not None and right is not None:
            met = left["_met"].to_numpy().copy()
            codes, others = _codes(left, right)
            begin, at = left["_at"].to_numpy(), right["_at"].to_numpy()
            # new left rows meet all right rows, held ones only the new
            for some, first in ((slice(left_old, None), 0), (slice(0, left_old), right_old)):
                order, low, high = meetings(codes[some], begin[some], others[first:], at[first:], span)
                met[some] |= high > low
                for own, other in _pairs(order, low, high):
                    found = left.drop_columns(["_at", "_key", "_met"]).take(own + some.start if some.start else own)
                    lines = right.drop_columns(["_at", "_key", "_met"]).take(other + first)
                    for name in lines.column_names:
                        found = found.append_column(name, lines[name])
                    yield told(MATCHED, place, found)
            left = left.set_column(left.column_names.index("_met"), "_met", pa.array(met))

        wake = []
        if left is not None:
            begin, met = left["_at"].to_numpy(), left["_met"].to_numpy()
            last = begin + span
            useful = np.minimum(last, (place + 1) * size - 1) > mark
            if outer:
                over = ~met & (last < mark)
                alone, home = left.drop_columns(["_met"]).filter(pa.array(over)), begin[over] // size
                order = np.argsort(home, kind="stable")
                alone, home = alone.take(order), home[order]
                for low, high in _edges(home):
                    copy = pa.array(np.full(high - low, home[low] != place))
                    yield told(ALONE, int(home[low]), alone.slice(low, high - low).append_column("_copy", copy))
                waits = ~met & ~over
                useful |= waits
                wake += [last[waits].min()] if waits.any() else []
            left = left.filter(pa.array(useful))
            wake += [] if wake or not useful.any() else [last[useful].max()]
        if right is not None:
            right = right.filter(pc.greater(right["_at"], mark))
            wake += [right["_at"].to_numpy().max()] if right.num_rows and not wake else []
        if wake:
            state.update(tuple(_packed(x) if x is not None and x.num_rows else None for x in (left, right)))
            state.setTimeoutTimestamp(max(int(wake[0]) // 1000, mark_ms))
        elif state.exists:
            state.remove()

    return update


def _told(kinds: pa.Schema, size: int, span: int):
    """Joined rows as they are; left rows that are alone in each of their spans, with NULLs.

    All copies of a row report in one batch, the one whose watermark passes the row's interval,
    and equal rows come out as often as they came in."""

    def settled(parts: list[bytes]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_tables([_unpacked(part) for part in parts])
        own = [name for name in kinds.names if name in rows.column_names]
        counted = rows.group_by([*own, "_at"]).aggregate([("_copy", "sum"), ("_copy", "count")])
        again = counted["_copy_sum"].to_numpy().astype(np.int64)
        first = counted["_copy_count"].to_numpy() - again
        at = counted["_at"].to_numpy()
        times = np.where((at + span) // size > at // size, np.minimum(first, again), first)
        ends = np.cumsum(times)
        for low in range(0, int(ends[-1]), BLOCK):
            some = counted.take(np.searchsorted(ends, np.arange(low, min(low + BLOCK, int(ends[-1]))), "right"))
            values = [some[f.name] if f.name in own else pa.nulls(some.num_rows, f.type) for f in kinds]
            yield from pa.table(values, kinds.names).combine_chunks().to_batches()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone = []
        for batch in batches:
            for kind, part in zip(batch["kind"].to_pylist(), batch["part"].to_pylist()):
                if kind == ALONE:
                    alone.append(part)
                else:
                    yield from _unpacked(part).to_batches()
        if alone:
            yield from settled(alone)

    return task


def _side(df: DataFrame, key: str, moment: str, names: list[str], buckets: int) -> DataFrame:
    return df.select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket"),
        F.unix_micros(F.col(moment).cast("timestamp")).alias("_at"),
        F.col(key).alias("_key"),
        *[F.col(c).alias(name) for c, name in zip(df.columns, names)],
    ).where("_at is not null")


def join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, days: int, outer: bool, buckets: int
) -> DataFrame:
    """See ``state.interval_join`` and ``state.outer_interval_join``."""
    span = days * DAY
    size = max(span, DAY)
    lines = [c for c in right.columns if c != key]
    own, other = [f"l{n}" for n in range(len(left.columns))], [f"r{n}" for n in range(len(lines))]
    lefts = _side(left, key, left_time, own, buckets)
    rights = _side(right.select(key, *lines), key, right_time, ["rk", *other], buckets).drop("rk").where("_key is not null")
    cell = T._parse_datatype_string("bucket int, place bigint, side int, part binary")
    # the schema names the watermark; a cell's moment is its last, so one that goes has late rows only
    cell = cell.add("moment", T.TimestampType(), True, left.schema[left_time].metadata)
    cells = [
        rows.mapInArrow(_cells(side, size, span, MOST_ROWS, MOST_BYTES), cell)
        for side, rows in ((LEFT, lefts if outer else lefts.where("_key is not null")), (RIGHT, rights))
    ]
    kept = cells[0].union(cells[1]).groupBy("bucket", "place").applyInPandasWithState(
        _joined(size, span, outer),
        "kind int, key_bucket int, first bigint, cell binary",
        "lefts binary, rights binary",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    # under other names, for only a projection makes rows of them that can be shuffled
    kept = kept.select("kind", *[F.col(c).alias(n) for c, n in (("key_bucket", "bucket"), ("first", "home"), ("cell", "part"))])
    if outer:
        kept = kept.repartition("bucket", "home")
    fields = [*left.schema.fields, *[right.schema[c] for c in lines]]
    named = T.StructType([T.StructField(n, f.dataType) for n, f in zip([*own, *other], fields)])
    told = kept.mapInArrow(_told(to_arrow_schema(named), size, span), named)
    return told.select(*[F.col(n).alias(f.name) for n, f in zip(named.names, fields)])
