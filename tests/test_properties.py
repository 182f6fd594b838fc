"""Jobs against brute force on random input from fixed seeds."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tidemill.plans import analyses
from tidemill.plans.skew import agg_salted
from tidemill.sinks.keyed import upsert
from tidemill.streaming import offsets

SEEDS = [1, 2, 3]
DAY = datetime.date(2024, 2, 20)


def later(n):
    return DAY + datetime.timedelta(days=n)


@pytest.mark.parametrize("seed", SEEDS)
def test_streaks(spark, seed):
    rng = random.Random(seed)
    logins = [(1 if rng.random() < 0.3 else rng.randrange(9), rng.randrange(40)) for _ in range(150)]
    df = spark.createDataFrame([(u, later(d)) for u, d in logins], "u int, d date")
    want = {}
    for user in {u for u, _ in logins}:
        days = {d for u, d in logins if u == user}
        runs = [next(n for n in range(1, 50) if d + n not in days) for d in days]
        want[user] = max(runs)
    assert {r.u: r.n for r in analyses.longest_streaks(df, "u", "d", "n").collect()} == want


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("rows_per_task", [10**6, 20])
def test_peaks(spark, seed, rows_per_task):
    rng = random.Random(seed)
    ticks = [("hot" if i % 3 == 0 else rng.choice("abc"), i, rng.randrange(6)) for i in range(200)]
    df = spark.createDataFrame(ticks, "s string, t int, p int")
    want = set()
    for stock in {s for s, _, _ in ticks}:
        own = [(t, p) for s, t, p in ticks if s == stock]
        for (_, a), (t, b), (_, c) in zip(own, own[1:], own[2:]):
            if b > a and b > c:
                want.add((stock, t, "peak"))
            elif b < a and b < c:
                want.add((stock, t, "trough"))
    found = analyses.peaks_and_troughs(df, ["s"], ["t"], "p", rows_per_task).collect()
    assert {(r.s, r.t, r.kind) for r in found} == want and len(found) == len(want)


@pytest.mark.parametrize("seed", SEEDS)
def test_clamp_stays_inside_the_bounds(spark, seed):
    rng = random.Random(seed)
    bounds = [("t", p, low, low + rng.randrange(100)) for p in range(40)
              for low in [rng.randrange(1000)]]
    stored = [("t", p, rng.randrange(-50, 1200)) for p in range(0, 50, 2)]
    got = offsets.clamp(
        spark.createDataFrame(stored, "topic string, part int, offset bigint"),
        spark.createDataFrame(bounds, "topic string, part int, low bigint, high bigint"))
    start = {r.part: r.start_offset for r in got.collect()}
    known = {p: o for _, p, o in stored}
    assert start == {p: max(low, min(high, known.get(p, 0))) for _, p, low, high in bounds}


@pytest.mark.parametrize("seed", SEEDS)
def test_upsert_is_a_dictionary_update(spark, seed):
    rng = random.Random(seed)
    base = {k: rng.randrange(100) for k in range(50)}
    changes = [(rng.randrange(70), rng.randrange(100), i) for i in range(60)]
    frame = upsert(spark.createDataFrame(list(base.items()), "k int, v int"),
                   spark.createDataFrame(changes, "k int, v int, seq int"), ["k"], "seq")
    base.update({k: v for k, v, _ in changes})
    rows = frame.collect()
    assert {r.k: r.v for r in rows} == base and len(rows) == len(base)


@pytest.mark.parametrize("seed", SEEDS)
def test_visitors(spark, seed):
    rng = random.Random(seed)
    visits = [("hot" if rng.random() < 0.3 else f"v{rng.randrange(15)}", rng.randrange(6))
              for _ in range(120)]
    df = spark.createDataFrame([(v, later(d)) for v, d in visits], "v string, d date")
    first = {v: min(d for w, d in visits if w == v) for v, _ in visits}
    want = {later(d): (sum(e == d for _, e in visits), len({v for v, e in visits if e == d}),
                       sum(f == d for f in first.values())) for d in {d for _, d in visits}}
    got = analyses.page_and_visitor_counts(df, "v", "d").collect()
    assert {r.d: (r.pv, r.uv, r.new_uv) for r in got} == want


@pytest.mark.parametrize("seed", SEEDS)
def test_salted_sums(spark, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.4 else rng.choice("ab"), rng.randrange(9)) for _ in range(99)]
    df = spark.createDataFrame(rows, "k string, v int").repartition(4)
    got = agg_salted(df, ["k"], {"s": ("sum", F.col("v")), "n": ("count", F.col("v"))}, 3)
    want = {k: (sum(v for j, v in rows if j == k), sum(j == k for j, _ in rows))
            for k in {k for k, _ in rows}}
    assert {r.k: (r.s, r.n) for r in got.collect()} == want
