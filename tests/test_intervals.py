"""Joins of two streams by key and span of time: one state for matches and for missing matches."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from tidemill.sources import streams
from tidemill.streaming import intervals, runner, state
from tidemill.tables import Tables

KINDS = "key string, a timestamp, n int, x double, note string", "key string, b timestamp, line bigint"
START = datetime.datetime(2024, 1, 1)


def day(n):
    return START + datetime.timedelta(days=n)


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def sides(n=400):
    key = lambda i, m: None if i % 37 == 5 else "hot" if i % 3 == 0 else f"k{i % m}"
    left = [(key(i, 19), day(i / 5), None if i % 4 else i, float("nan") if i % 6 == 0 else i / 8, None) for i in range(n)]
    right = [(key(i, 23), day(i / 5 + i % 7), 2**60 + i) for i in range(n) if i % 30 > 8]
    return [*left, *left[:50], ("k1", None, 1, 1.0, "never")], [*right, ("k1", None, 1)]


@pytest.mark.parametrize("outer", [False, True])
def test_streams_join_like_tables_with_one_state(spark, tmp_path, outer):
    folders = [str(tmp_path / x) for x in ("left", "right")]
    tables = sides()
    for run in range(4):
        for rows, kind, folder in zip(tables, KINDS, folders):
            part = [r for r in rows if (r[1] is None and run == 0) or (r[1] and (r[1] - START).days // 24 == run)]
            spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(folder)
        a, b = (
            streams.event_time(spark.readStream.schema(kind).parquet(folder), moment, "9 days")
            for kind, folder, moment in zip(KINDS, folders, "ab")
        )
        build = state.outer_interval_join if outer else state.interval_join
        done = build(a, b, "key", "a", "b", 4, 3)
        runner.run_to_files(done, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert os.listdir(tmp_path / "cp" / "state") == ["0"]  # outer: three before
    a, b = (spark.createDataFrame(rows, kind) for rows, kind in zip(tables, KINDS))
    mark = min(max(r[1] for r in rows if r[1]) for rows in tables) - datetime.timedelta(days=9)
    meets = (a.key == b.key) & F.col("b").between(F.col("a"), F.col("a") + F.expr("interval 4 days"))
    want = a.join(b, meets, "left" if outer else "inner").drop(b.key)
    want = want.where(F.col("line").isNotNull() | (F.col("a") + F.expr("interval 4 days") < F.lit(mark)))
    got = spark.read.schema(done.schema).parquet(str(tmp_path / "out"))
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want)
    assert not outer or want.where("line is null").count() > 50


def test_meetings_are_all_pairs_within_the_span():
    import numpy as np

    draw = np.random.default_rng(5)
    left, begin, right, at = draw.integers(-1, 4, 60), draw.integers(0, 50, 60), draw.integers(0, 4, 70), draw.integers(0, 50, 70)
    order, low, high = intervals.meetings(left, begin, right, at, 7)
    got = {(l, r) for own, other in intervals._pairs(order, low, high) for l, r in zip(own.tolist(), other.tolist())}
    want = {(l, r) for l in range(60) for r in range(70) if left[l] == right[r] and 0 <= at[r] - begin[l] <= 7}
    assert got == want and want


def test_other_frames_join_as_before(spark):
    """No streams, or keys that are not equal byte by byte: Spark's join."""
    left, right = (spark.createDataFrame([(0.0, day(1), i)], f"key double, {c} timestamp, {c}{c} int") for i, c in enumerate("ab"))
    assert not intervals.fits(left, right, "key", "a", "b")
    assert state.interval_join(left, right, "key", "a", "b", 2).count() == 1


@pytest.mark.parametrize("count", [0, 1, 40])
def test_arrivals_are_whole_and_in_order(spark, tmp_path, count):
    """The table is read once for all spans; before, it was read once per span."""
    rows = [(i, day(i % 10) if i % 9 else None) for i in range(count)]
    orders = spark.createDataFrame(rows, "o_orderkey bigint, o_orderdate timestamp")
    filled = orders.select(
        "o_orderkey", F.lit(1).cast("bigint").alias("o_custkey"), F.lit("x").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"), F.col("o_orderdate").cast("timestamp_ntz"), F.lit("y").alias("o_orderpriority"),
    )
    filled.write.parquet(f"{tmp_path}/orders.parquet")
    t = Tables(spark, str(tmp_path))
    before, last = 0, None
    folder = f"{tmp_path}/in"
    for _ in t.arrivals("orders", "o_orderdate", folder):
        seen = spark.read.schema(t.orders.schema).parquet(folder)
        now, top = seen.count(), seen.agg(F.max("o_orderdate")).first()[0]
        assert now >= before and (last is None or top is None or top >= last)
        before, last = now, top or last
    assert rows_of(seen) == rows_of(t.orders.where("o_orderdate is not null"))
    files = [p for p in os.listdir(folder) if p.endswith(".parquet")]
    assert len(files) >= 4  # an empty span has a file as well, so that each arrival is a batch
    assert count < 40 or {p[:2] for p in files} == {"0-", "1-", "2-", "3-"}
