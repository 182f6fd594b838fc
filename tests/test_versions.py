"""Changes are seen whole: failures between any two steps, two writers, odd part names."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemill.sinks import keyed, versions
from tidemill.sinks.files import write_partitioned
from tidemill.sources import streams
from tidemill.streaming import delivery, runner

DDL = "k int, part string, v int"
ODD = ["a@b", "é", "x,y", "t+u", "p&q", "A", "sp ace", "100%", "a/b", "c=d", "e:f", None]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, DDL)


def changes(spark, rows):
    return spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], f"{DDL}, seq int")


@pytest.fixture
def store(spark, tmp_path):
    made = versions.Store(spark, str(tmp_path / "store"))
    change = made.change()
    change.put("t", table(spark, [(n, p, 0) for n, p in enumerate(ODD)]), by="part")
    change.commit()
    return made


def test_every_part_name_loses_its_moved_key(spark, store):
    change = store.change()
    moved = [(n, ODD[(n + 1) % len(ODD)], 1) for n in range(len(ODD))]
    change.upsert("t", changes(spark, [*((n, p, 7) for n, p, _ in moved), *moved, (99, "new", 2)]), ["k"], "seq", "part")
    change.commit()
    assert rows_of(store.read("t")) == rows_of(table(spark, [*moved, (99, "new", 2)]))
    assert len(rows_of(store.read("t", 1))) == len(ODD)
    untouched = {f for p, fs in store.version().tables["t"].parts.items() for f in fs}
    change = store.change()
    change.upsert("t", changes(spark, [(99, "new", 3)]), ["k"], "seq", "part")
    change.commit()
    after = {f for p, fs in store.version().tables["t"].parts.items() for f in fs}
    assert len(untouched & after) == len(untouched) - 1


def test_partition_folders_too(spark, tmp_path):
    path = str(tmp_path / "plain")
    names = [p for p in ODD if p is not None]
    write_partitioned(table(spark, [(n, p, 0) for n, p in enumerate(names)]), path, ["part"])
    moved = [(n, "Z", 1) for n in range(len(names))]
    keyed.upsert_partitions(path, changes(spark, moved), ["k"], "seq", "part")
    assert rows_of(spark.read.schema(DDL).parquet(path).select("k", "part", "v")) == sorted(moved, key=str)


@pytest.mark.parametrize("step", ["_write", "_publish", "_move"])
@pytest.mark.parametrize("when", ["before", "after"])
def test_a_failure_between_two_steps_shows_all_or_nothing(spark, store, monkeypatch, step, when):
    old = rows_of(store.read("t"))
    owner = versions.Change if step == "_write" else versions.Store
    whole = getattr(owner, step)

    def failing(self, *args):
        if when == "after":
            whole(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(owner, step, failing)
    with pytest.raises(RuntimeError, match="lost"):
        change = store.change()
        change.upsert("t", changes(spark, [(0, "é", 5)]), ["k"], "seq", "part")
        change.put("other", table(spark, [(1, "o", 1)]))
        change.commit()
    monkeypatch.setattr(owner, step, whole)
    done = step in ("_publish", "_move") and when == "after"
    new = sorted([(0, "é", 5), *(r for r in old if r[0] != 0)], key=str)
    assert rows_of(store.read("t")) == (new if done else old)
    assert ("other" in store.version().tables) == done
    # and the work can be done again
    change = store.change()
    change.upsert("t", changes(spark, [(0, "é", 5)]), ["k"], "seq", "part")
    change.commit()
    store.forget(1)
    assert rows_of(store.read("t")) == new


def test_of_two_writers_one_is_refused(spark, store):
    first, second = store.change(), store.change()
    first.put("t", table(spark, [(50, "A", 1)]), by="part")
    second.put("t", table(spark, [(60, "A", 1)]), by="part")
    assert second.commit() == 2
    with pytest.raises(versions.Conflict):
        first.commit()
    keys = {r["k"] for r in store.read("t").collect()}
    assert 60 in keys and 50 not in keys and store.numbers() == [1, 2]


def test_batches_replace_themselves_and_old_versions_go(spark, store, tmp_path):
    for n in (1, 2, 2):
        change = store.change()
        change.put("b", table(spark, [(n, "x", n)]), part=f"batch-{n}")
        change.commit()
    assert rows_of(store.read("b")) == [(1, "x", 1), (2, "x", 2)]
    store.forget(1)
    assert store.numbers() == [4]
    assert rows_of(store.read("b")) == [(1, "x", 1), (2, "x", 2)]
    assert len(rows_of(store.read("t"))) == len(ODD)
    kept = [p for p in (tmp_path / "store" / "data").glob("*/*") if p.is_dir()]
    assert len(kept) == len(store.version().tables["t"].folders()) + 2


def test_expired_days_are_dropped_and_only_days_that_shrink_are_written(spark, tmp_path):
    store = versions.Store(spark, str(tmp_path / "metrics"))
    at = [datetime.datetime(2024, 1, d, h) for d, h in ((1, 5), (2, 1), (2, 23), (3, 5), (3, 6))]
    rows = spark.createDataFrame([("k", "e", t, 1.0, t.date()) for t in at], "rowkey string, event string, ts timestamp, value double, day date")
    change = store.change()
    change.put("m", rows, by="day")
    change.commit()
    before = store.version().tables["m"].parts
    now = F.lit(datetime.datetime(2024, 1, 3, 12)).cast("timestamp")
    versions.expire_metrics(store, "m", now, ttl_hours=24)
    after = store.version().tables["m"].parts
    assert sorted(after) == ["_part=2024-01-02", "_part=2024-01-03"]
    assert after["_part=2024-01-03"] == before["_part=2024-01-03"]
    assert sorted(r["ts"] for r in store.read("m").collect()) == at[2:]


def lines_in(folder, names):
    folder.mkdir(exist_ok=True)
    for name in names:
        (folder / f"{name}.txt").write_text(f"{name}\n")


def test_runs_until_every_file_is_read(spark, tmp_path):
    folder, out, log = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "log")
    lines_in(folder, "edcba")

    def run():
        read = streams.line_stream(spark, str(folder), log, files_per_batch=2)
        runner.run_to_files(read, out, str(tmp_path / "cp"), "text")

    assert streams.run_until_read(spark, str(folder), log, run) == 3
    assert sorted(r.value for r in spark.read.text(out).collect()) == list("abcde")


def test_old_entries_are_folded(spark, tmp_path):
    folder, log = tmp_path / "in", tmp_path / "log"
    folder.mkdir()
    options = {k.lower(): v for k, v in streams.line_options(spark, str(folder), str(log), keep_entries=2).items()}
    for n in range(9):
        lines_in(folder, [f"f{n}"])
        if n == 5:
            (folder / "f0.txt").unlink()
        reader = streams.LineReader(options)
        assert reader.latestOffset() == {"entry": n + 1}
        reader.commit({"entry": n + 1})
    names = sorted(p.name for p in log.iterdir() if p.name[0] != ".")
    assert names == ["000000007", "000000008", "000000009", "seen-000000006"]
    again = streams.LineReader(options)
    assert again.waiting() == [] and len(again.seen) == 8
    assert [streams.LineReader({**options, "start": s}).initialOffset()["entry"] for s in ("0", "8", "99")] == [6, 8, 9]


def test_a_new_checkpoint_goes_on_at_the_stored_offset(spark, tmp_path):
    folder, log = tmp_path / "in", str(tmp_path / "log")
    store = versions.Store(spark, str(tmp_path / "store"))

    def run(owner, start):
        read = streams.line_stream(spark, str(folder), log, start=start, with_entry=True)
        last = lambda frame: frame.agg(F.max("entry").alias("offset"))
        delivery.deliver_versions(read, store, owner, str(tmp_path / owner), last)
        return max(r["offset"] for r in store.read("offsets").collect())

    lines_in(folder, "ab")
    assert run("one", None) == 1
    lines_in(folder, "cd")
    assert run("two", 1) == 2
    assert run("two", 1) == 2  # nothing new; the checkpoint knows
    assert sorted(r["value"] for r in store.read("results").collect()) == list("abcd")
