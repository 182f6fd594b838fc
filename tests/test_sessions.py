"""Sessions kept in cells: a state per bucket of keys, one timer after the other."""

import datetime

import numpy as np
from pyspark.sql import functions as F

from tidemill.streaming import runner, timed

START = datetime.datetime(2024, 1, 1)


def test_stretches_of_several_keys_in_any_order():
    draw = np.random.default_rng(3)
    for _ in range(50):
        n = int(draw.integers(1, 40))
        key, start, length = draw.integers(-2, 3, n), draw.integers(0, 60, n), draw.integers(0, 12, n)
        stop, cnt = start + length, draw.integers(1, 4, n)
        want = []
        for k in sorted(set(key.tolist())):
            for a, b, c in sorted(zip(start[key == k].tolist(), stop[key == k].tolist(), cnt[key == k].tolist())):
                if want and want[-1][0] == k and a <= want[-1][2] + 5:
                    want[-1] = (k, want[-1][1], max(b, want[-1][2]), want[-1][3] + c, want[-1][4] - c)
                else:
                    want.append((k, a, b, c, -c))
        assert list(zip(*(c.tolist() for c in timed.stretches(5, key, start, stop, cnt, -cnt)))) == want


def test_a_state_holds_many_keys_and_its_timers_follow_each_other(spark, tmp_path):
    """Before, each session was an entry of the state with a timer of its own."""
    folder, out, checkpoint = (str(tmp_path / x) for x in ("in", "out", "checkpoint"))

    def run(rows):
        rows = [(START + datetime.timedelta(seconds=s), k, 1) for k, s in rows]
        spark.createDataFrame(rows, "ts timestamp, k bigint, v int").coalesce(1).write.mode("append").parquet(folder)
        stream = spark.readStream.schema("ts timestamp, k bigint, v int").parquet(folder)
        runner.run_to_files(timed.sessions(stream, "k", "ts", F.col("v"), 30, "0 seconds", 2), out, checkpoint)
        entries = spark.read.format("statestore").option("stateVarName", "open").load(checkpoint).count()
        keys = sorted(r["key"] for r in timed.snapshot(spark, checkpoint, "open").collect())
        closed = sorted(r["key"] for r in spark.read.parquet(out).collect())
        assert sorted(keys + closed) == sorted(seen)
        return entries, keys

    seen = list(range(40))
    # session k ends at 30 + k; the watermark is 39 and ends those up to 9, the rest in turn
    assert run([(k, k) for k in range(40)]) == (2, list(range(10, 40)))
    seen.append(100)
    assert run([(100, 45)]) == (2, [*range(16, 40), 100])
    seen.append(101)
    assert run([(101, 60)]) == (2, [*range(31, 40), 100, 101])
    seen.append(102)
    entries, keys = run([(102, 500)])
    assert keys == [102] and entries == 1
