"""User aggregates with partial states: zero, reduce, merge, finish.

A task reduces its rows batch by batch into one state per key and sends the states, not the
rows. States meet in a tree: in each round at most ``fan`` states of a key are merged in one call,
so a key with any share of the rows, from any number of tasks, costs a task a bounded number of
states at a time. A task that holds ``KEYS_HELD`` keys sends what it has and goes on.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import materialize

FAN = 32
KEYS_HELD = 100_000
STATE, NTH, GROUP = "_state", "_nth", "_group"


class Aggregator:
    """A state is anything that pickles. ``reduce`` and ``merge`` may change and return the first."""

    def zero(self):
        raise NotImplementedError

    def reduce(self, state, rows: pa.Table):
        """The state with some rows of one key taken in."""
        raise NotImplementedError

    def merge(self, one, two):
        raise NotImplementedError

    def finish(self, state) -> dict:
        """Values of the result columns."""
        raise NotImplementedError


def _groups(table: pa.Table, keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """The rows of each key; NULL is a key like any other."""
    kinds = table.select(keys).group_by(keys).aggregate([])
    if kinds.num_rows == 1:
        yield tuple(kinds.column(k)[0].as_py() for k in keys), table
        return
    ordered = table.sort_by([(k, "ascending") for k in keys])
    counted = ordered.group_by(keys, use_threads=False).aggregate([([], "count_all")])
    at = 0  # groups of a sorted table come in its order
    for row in counted.to_pylist():
        yield tuple(row[k] for k in keys), ordered.slice(at, row["count_all"])
        at += row["count_all"]


def _reduced(aggregator: Aggregator, keys: list[str], schema: pa.Schema):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, object] = {}
        sent = 0

        def send() -> pa.RecordBatch:
            columns = [[k[i] for k in held] for i in range(len(keys))]
            columns += [[TaskContext.get().partitionId()] * len(held), [sent] * len(held)]
            columns.append([pickle.dumps(state) for state in held.values()])
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
            )

        for batch in batches:
            for key, rows in _groups(pa.Table.from_batches([batch]), keys):
                state = held[key] if key in held else aggregator.zero()
                held[key] = aggregator.reduce(state, rows)
            if len(held) >= KEYS_HELD:
                yield send()
                held, sent = {}, sent + 1
        if held:
            yield send()

    return task


def _merged(aggregator: Aggregator, keys: list[str]):
    def merge(table: pa.Table) -> pa.Table:
        state = None
        for chunk in table.column(STATE).to_pylist():
            other = pickle.loads(chunk)
            state = other if state is None else aggregator.merge(state, other)
        first = table.slice(0, 1).drop_columns([STATE])
        return first.append_column(STATE, pa.array([pickle.dumps(state)], pa.binary()))

    return merge


def _finished(aggregator: Aggregator, keys: list[str], names: list[str], schema: pa.Schema):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [aggregator.finish(pickle.loads(s)) for s in batch[STATE].to_pylist()]
            columns = [batch[k].cast(schema.field(k).type) for k in keys]
            columns += [pa.array([r[n] for r in rows], schema.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return task


def aggregate(
    df: DataFrame, keys: list[str], aggregator: Aggregator, result: str, fan: int = FAN
) -> DataFrame:
    """One row per key with the columns of ``result`` (a schema string)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    key_fields = [T.StructField(k, df.schema[k].dataType) for k in keys]
    more = [("_task", T.IntegerType()), ("_sent", T.LongType()), (STATE, T.BinaryType())]
    wide = T.StructType([*key_fields, *(T.StructField(n, t) for n, t in more)])
    states = materialize(df.mapInArrow(_reduced(aggregator, keys, to_arrow_schema(wide)), wide), "states")
    # what tasks sent is numbered without gaps: a row per task and sending, whatever the keys
    sendings = states.select("_task", "_sent").distinct()
    numbered = sendings.withColumn(NTH, F.row_number().over(Window.orderBy("_task", "_sent")) - 1)
    numbered = materialize(numbered, "sendings")
    left = numbered.count()
    states = states.join(F.broadcast(numbered), ["_task", "_sent"]).select(*keys, NTH, STATE)
    schema = T.StructType([*key_fields, T.StructField(NTH, T.IntegerType()), T.StructField(STATE, T.BinaryType())])
    while left > 1:
        states = states.withColumn(NTH, F.floor(F.col(NTH) / fan).cast("int"))
        states = states.groupBy(*keys, NTH).applyInArrow(_merged(aggregator, keys), schema)
        left = -(-left // fan)
    fields = T._parse_datatype_string(result).fields
    out = T.StructType([*key_fields, *fields])
    names = [f.name for f in fields]
    return states.mapInArrow(_finished(aggregator, keys, names, to_arrow_schema(out)), out)


class TopDistinct(Aggregator):
    """The ``n`` largest different values of a column and how many rows have each: the n-th of
    them (or the smallest, if there are fewer) and the rows of all. NULL is no value."""

    def __init__(self, column: str, n: int):
        self.column, self.n = column, n

    def zero(self) -> dict:
        return {}

    def _cut(self, state: dict) -> dict:
        return {v: state[v] for v in sorted(state, reverse=True)[: self.n]}

    def reduce(self, state: dict, rows: pa.Table) -> dict:
        for pair in rows.column(self.column).drop_null().value_counts().to_pylist():
            state[pair["values"]] = state.get(pair["values"], 0) + pair["counts"]
        return self._cut(state)

    def merge(self, one: dict, two: dict) -> dict:
        for value, count in two.items():
            one[value] = one.get(value, 0) + count
        return self._cut(one)

    def finish(self, state: dict) -> dict:
        return {"least": min(state, default=None), "rows": sum(state.values())}
