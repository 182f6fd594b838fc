"""Blocked and plain paths of OrderedKeys must agree, whatever the key sizes."""

import pytest
from pyspark.sql import functions as F

from tidemill.plans.ordered import BlockedKeys, OrderedKeys, collect_chunks


@pytest.fixture(scope="module")
def rows(spark):
    # one key holds a third of the rows, one key is NULL, values repeat
    data = []
    for i in range(900):
        key = 0 if i % 3 == 0 else (None if i % 7 == 0 else i % 11)
        data.append((key, i % 40, i, float(i % 13) if i % 17 else None))
    return spark.createDataFrame(data, "k int, o int, id int, v double")


def both(rows, order, call):
    plain = OrderedKeys(rows, ["k"], order)
    hot = OrderedKeys(rows, ["k"], order, rows_per_task=50)
    assert not plain.blocked and hot.blocked
    return [sorted(map(str, call(x).collect())) for x in (plain, hot)]


@pytest.mark.parametrize("order", [["o", "id"], ["-o", "id"]])
def test_position(rows, order):
    a, b = both(rows, order, lambda x: x.position("p"))
    assert a == b


@pytest.mark.parametrize("kind", ["sum", "count", "min", "max"])
def test_running(rows, kind):
    a, b = both(rows, ["o", "id"], lambda x: x.running("r", kind, F.col("v")))
    assert a == b


@pytest.mark.parametrize("kind", ["sum", "count", "min", "max"])
def test_running_range(rows, kind):
    a, b = both(rows, ["o"], lambda x: x.running_range("r", kind, F.col("v")))
    assert a == b


def test_ranks(rows):
    a, b = both(rows, ["-o"], lambda x: x.ranks("r", "d"))
    assert a == b


def test_framed(rows):
    columns = {
        "before": lambda w: F.lag("v", 2).over(w),
        "after": lambda w: F.lead("v", 2).over(w),
        "near": lambda w: F.sum("v").over(w.rowsBetween(-1, 1)),
    }
    a, b = both(rows, ["o", "id"], lambda x: x.framed(columns, 2))
    assert a == b


def test_framed_with_slices_smaller_than_reach(rows):
    columns = {"before": lambda w: F.lag("v", 9).over(w)}
    plain = OrderedKeys(rows, ["k"], ["o", "id"]).framed(columns, 9)
    hot = OrderedKeys(rows, ["k"], ["o", "id"], rows_per_task=5).framed(columns, 9)
    assert sorted(map(str, plain.collect())) == sorted(map(str, hot.collect()))


def test_totals(rows):
    a, b = both(rows, ["o", "id"], lambda x: x.totals("t", F.sum("v")))
    assert a == b


def test_collect_chunks_keeps_every_value(rows):
    chunks = collect_chunks(rows, ["k"], ["o", "id"], "id", chunk_rows=40, rows_per_task=50)
    got = {}
    for r in sorted(chunks.collect(), key=lambda r: r["chunk"]):
        assert len(r["items"]) <= 40
        got.setdefault(r["k"], []).extend(r["items"])
    want = {}
    for r in sorted(rows.collect(), key=lambda r: (r["o"], r["id"])):
        want.setdefault(r["k"], []).append(r["id"])
    assert got == want


def test_copies_are_spread_over_blocks(spark):
    copies = spark.range(4000, numPartitions=40).select(F.lit(1).alias("k"), F.lit(7).alias("v"))
    blocked = BlockedKeys(copies, ["k"], ["v"], 4000, 400)
    sizes = [r["count"] for r in blocked.ranged().groupBy("_block").count().collect()]
    assert sum(sizes) == 4000 and max(sizes) < 1000
    chunks = collect_chunks(copies, ["k"], ["v"], "v", chunk_rows=300, rows_per_task=400)
    assert sorted(len(r["items"]) for r in chunks.collect()) == [100] + [300] * 13


def test_no_keys(rows):
    numbered = OrderedKeys(rows, [], ["id"], rows_per_task=100).position("p")
    assert [(r["id"], r["p"]) for r in numbered.orderBy("id").collect()] == [
        (i, i + 1) for i in range(900)
    ]
