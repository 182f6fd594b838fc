"""Sessions and panes: their parts against plain versions, and what the state holds."""

import datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.streaming import runner, timed


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=30), st.integers(0, 9), st.randoms())
def test_sessions_merge_in_any_order(moments, gap, random):
    want = []
    for at in sorted(moments):
        if want and at - want[-1][1] <= gap:
            want[-1] = (want[-1][0], at, gap, want[-1][3] + 1, want[-1][4] + at)
        else:
            want.append((at, at, gap, 1, at))
    random.shuffle(moments)
    held = []
    for n in range(0, len(moments), 4):
        held = timed.merged(held + [(at, at, gap, 1, at) for at in moments[n : n + 4]])
    assert held == want


@settings(max_examples=200, deadline=None)
@given(
    st.dictionaries(st.integers(-20, 40), st.tuples(st.integers(1, 3), st.integers(-9, 9), st.integers(-9, 9)), max_size=25),
    st.integers(1, 8), st.integers(-30, 45), st.integers(0, 30),
)
def test_sliding_sums_and_maxima(panes, width, first, count):
    last = first + count
    want = []
    for start in range(first, last + 1):
        inside = [panes[s] for s in range(start, start + width) if s in panes]
        if inside:
            want.append((start, sum(p[0] for p in inside), sum(p[1] for p in inside), max(p[2] for p in inside)))
    ordered = sorted((slot, *p) for slot, p in panes.items())
    assert timed.slide(ordered, first, last, width) == (want, last + 1)


def test_a_pane_moves_at_most_three_times():
    window = timed.Slide()
    moves = 0
    for n in range(1000):
        window.push((n, 1, n, n % 7))
        if n >= 100:
            held = len(window.back) if not window.front else 0
            window.pop()
            moves += held
    assert moves <= 1000 and (window.cnt, window.total) == (100, sum(range(900, 1000)))
    assert window.highest() == 6


def at(second):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=second)


def arrive(spark, folder, rows):
    df = spark.createDataFrame([(at(s), k, v) for s, k, v in rows], "ts timestamp, k string, v int")
    df.coalesce(1).write.mode("append").parquet(folder)


def test_the_state_is_one_row_per_pane_and_late_rows_are_left_out(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def run(rows):
        arrive(spark, folder, rows)
        stream = spark.readStream.schema("ts timestamp, k string, v int").parquet(folder)
        done = timed.paned_windows(stream, "ts", F.col("v"), 60, 10, "20 seconds", "k")
        runner.run_to_files(done, out, checkpoint)
        held = timed.snapshot(spark, checkpoint, "panes").collect()
        return {(r["key"], r["slot"] * 10 % 86400): r["cnt"] for r in held}

    # 2000 rows of one key in two panes: two rows of state; nothing has ended
    assert run([(n % 20, "a", 1) for n in range(2000)]) == {("a", 0): 1000, ("a", 10): 1000}
    # the watermark is at 80: windows that end until then are out, panes before 30 are gone
    assert run([(100, "a", 5), (25, "b", 2)]) == {("a", 100): 1}
    # a row at 70 is later than 20 seconds and adds nothing; 90 is not
    assert run([(70, "a", 9), (90, "a", 3), (100, "a", 4)]) == {("a", 90): 1, ("a", 100): 2}
    rows = spark.read.parquet(out).collect()
    base = datetime.datetime(2024, 1, 1)
    seen = {(r["key"], int((r["start"] - base).total_seconds())): (r["cnt"], r["total"], r["highest"]) for r in rows}
    assert len(seen) == len(rows)
    a = {-50: 1000, -40: 2000, -30: 2000, -20: 2000, -10: 2000, 0: 2000, 10: 1000}
    assert {s: c for (k, s), (c, _, _) in seen.items() if k == "a"} == a
    assert {s: v for (k, s), v in seen.items() if k == "b"} == {s: (1, 2, 2) for s in range(-30, 30, 10)}


def test_sessions_expire_and_the_snapshot_has_the_open_ones(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def run(rows):
        arrive(spark, folder, [(s, str(k), v) for s, k, v in rows])
        stream = spark.readStream.schema("ts timestamp, k string, v int").parquet(folder)
        done = timed.sessions(stream, "k", "ts", F.col("v"), 30, "0 seconds")
        runner.run_to_files(done, out, checkpoint)
        base = int(at(0).replace(tzinfo=datetime.timezone.utc).timestamp()) * timed.SECOND
        held = timed.snapshot(spark, checkpoint, "open").collect()
        return {(r["key"], (r["start"] - base) // 10**6, (r["stop"] - base) // 10**6): r["cnt"] for r in held}

    assert run([(0, 1, 1), (20, 1, 1), (0, 2, 1)]) == {(1, 0, 20): 2, (2, 0, 0): 1}
    # key 1 goes on; key 2 is closed by the time that passes, although nothing of it comes
    assert run([(45, 1, 1)]) == {(1, 0, 45): 3}
    assert run([(100, 3, 1)]) == {(3, 100, 100): 1}
    closed = {(r["key"], r["cnt"], r["total"]) for r in spark.read.parquet(out).collect()}
    assert closed == {(1, 3, 3), (2, 1, 1)}
