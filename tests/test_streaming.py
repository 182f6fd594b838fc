"""Streams over split files: equal to the batch result, restartable, late rows dropped."""

import datetime
import threading
import time
import uuid

import pytest
from pyspark.sql import functions as F

from tidemill.plans.skew import SALT
from tidemill.sinks.keyed import write_batch
from tidemill.sources import streams
from tidemill.streaming import delivery, runner, state
from tidemill.tables import SCHEMAS


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def split_events(small, tmp_path_factory):
    """The events in six files."""
    path = str(tmp_path_factory.mktemp("events") / "in")
    small.events.repartition(6).write.parquet(path)
    return path


def one_by_one(spark, path):
    return streams.file_stream(spark, "parquet", path, SCHEMAS["events"], files_per_trigger=1)


def test_running_count_in_every_mode(spark, small, split_events):
    want = rows_of(small.events.groupBy("event_type").agg(F.count(F.lit(1))))
    counts = lambda: state.running_count(one_by_one(spark, split_events), "event_type")
    assert rows_of(runner.completed(counts(), "c")) == want
    assert rows_of(runner.updated(counts(), ["event_type"], "u")) == want
    history = runner.batches(counts(), "h", "complete")
    assert history.select("batch_id").distinct().count() == 6


def test_windows_equal_the_batch_result(spark, small, split_events):
    def windows(df):
        total = [F.count(F.lit(1)).alias("cnt")]
        return state.windowed(df, "ts", "6 hours", "2 hours", total, ["event_type"])

    events = streams.event_time(one_by_one(spark, split_events), "ts", "40 days")
    got = runner.updated(windows(events), ["start", "event_type"], "w")
    assert rows_of(got) == rows_of(windows(small.events))


def write_rows(spark, path, rows):
    df = spark.createDataFrame(rows, "id int, ts timestamp, v int").coalesce(1)
    df.write.mode("append").parquet(path)


def at(hour, minute=0):
    return datetime.datetime(2024, 1, 1, hour, minute)


def test_late_row_is_dropped_and_closed_window_comes_once(spark, tmp_path):
    source, checkpoint, out = (str(tmp_path / n) for n in ("in", "cp", "out"))

    def run():
        read = streams.file_stream(spark, "parquet", source, "id int, ts timestamp, v int")
        timed = streams.event_time(read, "ts", "1 hour")
        sums = state.windowed(timed, "ts", "1 hour", None, [F.sum("v").alias("s")])
        runner.run_to_files(sums, out, checkpoint)
        return rows_of(spark.read.schema(sums.schema).parquet(out))

    write_rows(spark, source, [(1, at(1, 5), 1), (2, at(1, 10), 2), (3, at(5), 4)])
    first = run()
    assert first == [str((at(1), 3))]
    write_rows(spark, source, [(4, at(1, 20), 100), (5, at(9), 8)])
    assert run() == sorted([str((at(1), 3)), str((at(5), 4))])
    assert run() == sorted([str((at(1), 3)), str((at(5), 4))])


def test_append_complete_and_update_differ(spark, tmp_path):
    source = str(tmp_path / "in")
    write_rows(spark, source, [(1, at(1), 1), (2, at(5), 2)])

    def sums():
        read = streams.file_stream(spark, "parquet", source, "id int, ts timestamp, v int")
        timed = streams.event_time(read, "ts", "1 hour")
        return state.windowed(timed, "ts", "1 hour", None, [F.sum("v").alias("s")])

    assert runner.appended(sums(), "m").count() == 1
    assert runner.completed(sums(), "m").count() == 2
    assert runner.updated(sums(), ["start"], "m").count() == 2


def test_restart_goes_on(spark, small, tmp_path):
    queue, checkpoint, out = (str(tmp_path / n) for n in ("q", "cp", "out"))
    for half in (F.col("value") < 50, F.col("value") >= 50):
        streams.push(small.events.filter(half), queue)
        runner.run_to_files(
            streams.queue_stream(spark, queue, SCHEMAS["events"], one_at_a_time=True),
            out, checkpoint)
    back = spark.read.schema(SCHEMAS["events"]).parquet(out)
    assert rows_of(back) == rows_of(small.events)


def test_custom_source_reads_new_files_after_a_restart(spark, tmp_path):
    folder, checkpoint, out = tmp_path / "in", str(tmp_path / "cp"), str(tmp_path / "out")
    folder.mkdir()
    for name, body in (("m", 'one, "x"\ntwo\n'), ("a", "three\n")):
        (folder / f"{name}.txt").write_text(body)
        read = streams.line_stream(spark, str(folder), str(tmp_path / "log"))
        runner.run_to_files(read, out, checkpoint, "text")
    assert sorted(r.value for r in spark.read.text(out).collect()) == ['one, "x"', "three", "two"]


def test_custom_source_takes_files_in_portions(spark, tmp_path):
    folder, checkpoint, out = tmp_path / "in", str(tmp_path / "cp"), str(tmp_path / "out")
    folder.mkdir()
    for number in range(5):
        (folder / f"{9 - number}.txt").write_text(f"line {number}\n")
    for run in range(3):
        read = streams.line_stream(spark, str(folder), str(tmp_path / "log"), files_per_batch=2)
        runner.run_to_files(read, out, checkpoint, "text")
        assert spark.read.text(out).count() == min(5, 2 * run + 2)


def test_custom_source_repeats_a_failed_batch(spark, tmp_path):
    """A file that comes between the failure and the repetition is not part of the batch."""
    folder, out = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "m.txt").write_text("one\ntwo\n")
    seen = []

    def handle(frame, batch_id):
        seen.append(sorted(r.value for r in frame.collect()))
        if len(seen) == 1:
            raise RuntimeError("lost")
        write_batch(frame, batch_id, out)

    def run():
        read = streams.line_stream(spark, str(folder), str(tmp_path / "log"))
        runner.run_each_batch(read, handle, str(tmp_path / "cp"))

    with pytest.raises(Exception, match="lost"):
        run()
    (folder / "a.txt").write_text("three\n")
    run()
    run()
    assert seen == [["one", "two"], ["one", "two"], ["three"]]


@pytest.mark.parametrize("split_bytes", [1, 3, 7, 1000])
def test_custom_source_splits_files_between_lines(spark, tmp_path, split_bytes):
    lines = ["é one", "", "three", "x" * 40, "last"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("\n".join(lines))
    (folder / "b.txt").write_text("only\r\n")
    (folder / "empty.txt").write_text("")
    read = streams.line_stream(spark, str(folder), str(tmp_path / "log"), split_bytes)
    got = runner.appended(read, "split").collect()
    assert sorted(r.value for r in got) == sorted([*lines, "only"])


def test_custom_state_over_batches(spark, small, split_events):
    amount = F.col("value").cast("bigint").alias("amount")
    read = one_by_one(spark, split_events).select("user_id", amount)
    states = runner.updated(state.running_totals(read, "user_id", "amount"), ["user_id", SALT], "t")
    got = state.merged_totals(states, "user_id")
    want = small.events.select("user_id", amount).groupBy("user_id").agg(
        F.count(F.lit(1)), F.sum("amount"))
    assert rows_of(got) == rows_of(want)


def test_dedup_over_batches(spark, small, split_events):
    twice = one_by_one(spark, split_events).union(one_by_one(spark, split_events))
    timed = streams.event_time(twice, "ts", "40 days")
    for unique in (timed.dropDuplicates(["event_id", "ts"]),
                   state.unique(timed, ["event_id", "ts"])):
        assert runner.appended(unique, "d").count() == small.events.count()


def test_copies_go_before_the_state(spark, tmp_path):
    """Few copies of a hot key reach the one state, and one that is too late hides none in time."""
    hot = spark.range(6000, numPartitions=2).selectExpr(
        "if(id < 5000, -1, id) as event_id", "timestamp'2024-01-10 00:00:00' as ts", "if(id < 5000, 'hot', null) as event_type")
    hot = hot.union(hot.where("event_id > 0").limit(500))
    hot.repartition(2).write.parquet(str(tmp_path / "in"))
    for keys, moment in ((["event_id", "ts"], None), (["event_id"], "ts")):
        read = streams.file_stream(spark, "parquet", str(tmp_path / "in"), "event_id long, ts timestamp, event_type string")
        once = state.unique(read.withWatermark("ts", "1 day"), keys, moment)
        out, reports = str(tmp_path / f"out-{moment}"), []
        with runner.stream_conf(spark):
            writer = once.writeStream.option("checkpointLocation", str(tmp_path / f"kept-{moment}"))
            query = runner.finish(writer.trigger(availableNow=True).start(out))
            reports = [p for p in query.recentProgress if p.numInputRows]
        assert len(reports[0].stateOperators) == 1
        dropped = sum(p.stateOperators[0].customMetrics["numDroppedDuplicateRows"] for p in reports)
        assert dropped <= 520  # of 5499 copies
        got = spark.read.parquet(out)
        assert got.count() == got.select("event_id").distinct().count() == 1001

    def put(name, rows):
        spark.createDataFrame(rows, "event_id long, ts string").selectExpr(
            "event_id", "timestamp(ts) as ts").coalesce(1).write.mode("append").parquet(str(tmp_path / name))

    put("late", [(1, "2024-03-01")])
    for again in ([], [(2, "2024-01-01"), (2, "2024-03-02"), (3, "2024-01-01"), (4, None), (4, None)]):
        if again:
            put("late", again)
        read = streams.file_stream(spark, "parquet", str(tmp_path / "late"), "event_id long, ts timestamp")
        once = state.unique(read.withWatermark("ts", "1 day"), ["event_id"], "ts")
        runner.run_to_files(once, str(tmp_path / "out-late"), str(tmp_path / "kept-late"))
    assert sorted(r[0] for r in spark.read.parquet(str(tmp_path / "out-late")).collect()) == [1, 2, 4]


def test_interval_join_equals_the_plain_condition(spark, small):
    orders = small.orders.select(F.col("o_orderkey").alias("key"), "o_orderdate")
    lines = small.lineitem.select(F.col("l_orderkey").alias("key"), "l_shipdate", "l_quantity")
    for days in (1, 10, 400):
        bucketed = state.interval_join(orders, lines, "key", "o_orderdate", "l_shipdate", days)
        plain = orders.join(lines, "key").filter(
            (F.col("l_shipdate") >= F.col("o_orderdate"))
            & (F.col("l_shipdate") <= F.col("o_orderdate") + F.expr(f"INTERVAL {days} DAYS")))
        assert rows_of(bucketed) == rows_of(plain)


def test_outer_interval_join_with_a_hot_key_and_repeated_rows(spark, tmp_path):
    """A third of both sides has one key; rows of the same values count as often as they came."""
    kinds = "key bigint, a timestamp, tag int", "key bigint, b timestamp, line int"
    day = lambda n: datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n)
    left = [(0 if n % 3 == 0 else n % 23, day(n // 4), n % 2) for n in range(600)] * 2
    left += [(None, day(5), 1)]
    right = [(0 if n % 3 == 0 else n % 29, day(n // 3 + n % 5), n) for n in range(500) if n % 40 > 9]
    folders = [str(tmp_path / x) for x in ("left", "right")]
    for run in range(3):
        for rows, kind, folder in zip((left, right), kinds, folders):
            part = [r for r in rows if (r[1] - day(0)).days * 3 // 180 == run]
            spark.createDataFrame(part, kind).coalesce(1).write.mode("append").parquet(folder)
        a, b = (
            streams.event_time(spark.readStream.schema(kind).parquet(folder), moment, "7 days")
            for kind, folder, moment in zip(kinds, folders, "ab")
        )
        done = state.outer_interval_join(a, b, "key", "a", "b", 3)
        runner.run_to_files(done, str(tmp_path / "out"), str(tmp_path / "cp"))
    spark.createDataFrame(left, kinds[0]).createOrReplaceTempView("outer_left")
    spark.createDataFrame(right, kinds[1]).createOrReplaceTempView("outer_right")
    mark = min(max(r[1] for r in rows) for rows in (left, right)) - datetime.timedelta(days=7)
    want = spark.sql(
        f"""select l.key, a, tag, b, line from outer_left l left join outer_right r
            on l.key = r.key and b between a and a + interval 3 days
            where line is not null or a + interval 3 days < timestamp '{mark}'"""
    )
    got = spark.read.schema(done.schema).parquet(str(tmp_path / "out"))
    assert want.where("line is null").count() > 20
    assert rows_of(got) == rows_of(want)


def test_blacklist(spark, tmp_path):
    banned = spark.createDataFrame([("spark", True), ("scala", False)], "word string, b boolean")
    (tmp_path / "w.txt").write_text("1 hadoop\n2 spark\n3 scala\n4 java\n5 hive\n")
    lines = streams.text_stream(spark, str(tmp_path))
    words = lines.select(F.split("value", " ")[1].alias("word"))
    kept = words.join(F.broadcast(banned.filter("b")), "word", "left_anti")
    assert sorted(r.word for r in runner.appended(kept, "b").collect()) == [
        "hadoop", "hive", "java", "scala"]


def test_failed_batch_is_repeated_once(spark, small, split_events, tmp_path):
    """The handler fails after writing; the next run repeats the batch over itself."""
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    failed = []

    def handle(frame, batch_id):
        write_batch(frame, batch_id, out)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    with pytest.raises(Exception, match="lost after the write"):
        runner.run_each_batch(one_by_one(spark, split_events), handle, checkpoint)
    runner.run_each_batch(one_by_one(spark, split_events), handle, checkpoint)
    assert failed == [2]
    back = spark.read.parquet(out).select(*small.events.columns)
    assert rows_of(back) == rows_of(small.events)


def test_results_and_offsets_agree(spark, small, split_events, tmp_path):
    results, log = str(tmp_path / "r"), str(tmp_path / "o")

    def positions(frame):
        return frame.agg(F.lit("g").alias("grp"), F.lit("t").alias("topic"), F.lit(0).alias("part"),
                         F.max("event_id").alias("offset"), F.max("ts").alias("ts"))

    delivery.deliver_once(one_by_one(spark, split_events), results, log, str(tmp_path / "cp"),
                          positions)
    assert spark.read.parquet(log).count() == 6
    top = spark.read.parquet(results).groupBy("batch_id").agg(F.max("event_id").alias("offset"))
    assert rows_of(top) == rows_of(spark.read.parquet(log).select("batch_id", "offset"))


def test_one_folder_per_batch(spark, split_events, tmp_path):
    text = one_by_one(spark, split_events).select("event_type")
    runner.save_batches(text, str(tmp_path / "b"), str(tmp_path / "cp"), ".txt")
    folders = sorted(p.name for p in tmp_path.glob("b-*.txt"))
    assert folders == [f"b-{i}.txt" for i in range(6)]
    assert spark.read.text(str(tmp_path / "b-*.txt")).count() == text_count(spark, split_events)


def text_count(spark, path):
    return spark.read.parquet(path).count()


def test_marker_stops_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    marker = tmp_path / "stop"
    read = streams.text_stream(spark, str(tmp_path / "in"))
    name = f"m_{uuid.uuid4().hex[:8]}"
    query = read.writeStream.format("memory").queryName(name).trigger(
        processingTime="200 milliseconds").start()
    threading.Timer(2.0, lambda: marker.write_text("")).start()
    started = time.time()
    assert runner.stop_on_marker(query, str(marker), 0.2)
    assert not query.isActive and time.time() - started > 1.5


def test_rate_source(spark):
    name = f"r_{uuid.uuid4().hex[:8]}"
    query = streams.rate_stream(spark, 50, 2).writeStream.format("memory").queryName(name).start()
    deadline = time.time() + 60
    while spark.table(name).count() == 0 and time.time() < deadline:
        time.sleep(0.3)
    query.stop()
    assert spark.table(name).columns == ["timestamp", "value"] and spark.table(name).count() > 0


def test_console_sink(spark, split_events):
    writer = one_by_one(spark, split_events).groupBy("event_type").count().writeStream
    query = writer.format("console").outputMode("complete").option("numRows", 2).option(
        "truncate", True).trigger(availableNow=True).start()
    assert runner.finish(query).exception() is None


def test_file_options():
    assert streams.file_options(5, True, True) == {
        "maxFilesPerTrigger": "5", "latestFirst": "true", "fileNameOnly": "true"}
