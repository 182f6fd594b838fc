"""Cases that once lost, repeated or misplaced rows."""

import datetime
import re
import subprocess
import sys
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemill.functions import dates, text
from tidemill.operators.columns import levels
from tidemill.operators.sampling import hash_fraction
from tidemill.plans import analyses, skew
from tidemill.session import cluster_conf, folder_bytes, qualified, work_path
from tidemill.sinks import keyed
from tidemill.sinks.streams import FileWriterPerTask, open_store
from tidemill.streaming import delivery, state
from tidemill.tables import SCHEMAS


def rows_of(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_no_level_without_a_score(spark):
    df = spark.createDataFrame([(None,), (5.0,), (50.0,)], "score double")
    got = [r[0] for r in df.select(levels("score", [(10, "low")], "high")).collect()]
    assert got == [None, "low", "high"]


def test_pivot_keeps_a_missing_key_apart(spark):
    df = spark.createDataFrame(
        [(None, "a", 1.0), (0, "a", 2.0), (0, "z", 4.0)], "k int, kind string, v double"
    )
    want = {(None, 1.0, 0.0), (0, 2.0, 0.0)}
    assert {tuple(r) for r in analyses.pivot_sums(df, "k", "kind", ["a", "b"], "v").collect()} == want
    assert {tuple(r) for r in analyses.pivot_when(df, "k", "kind", ["a", "b"], "v").collect()} == want
    total = analyses.pivot_with_total(df, "k", "kind", ["a", "b"], "v")
    assert total.where("k = 'total'").first()["total"] == 7.0


def test_iso_texts_with_zones_and_fractions(spark):
    texts = ["2018-09-13T02:15:16.054Z", "2018-09-13T02:15:16-05:00", "2018-09-13T02:15:16", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(dates.iso_text_to_timestamp("s")).collect()]
    at = datetime.datetime(2018, 9, 13, 2, 15, 16)
    assert got == [at.replace(microsecond=54_000), at, at, None]


def test_log_lines_without_a_size(spark):
    line = '8.35.201.160 - - [16/May/2018:17:38:21 +0800] "GET /x HTTP/1.1" 304 -'
    df = spark.createDataFrame([(line,)], "line string")
    row = df.select(text.log_ip("line"), text.log_day("line")).first()
    assert tuple(row) == ("8.35.201.160", datetime.date(2018, 5, 16))


def test_the_whole_is_a_fraction_too(spark):
    df = spark.range(20_000)
    assert hash_fraction(df, ["id"], 1.0).count() == 20_000
    assert hash_fraction(df, ["id"], 0.0).count() == 0


def test_salts_spread_a_table_sorted_by_its_hot_key(spark, tmp_path):
    path = str(tmp_path / "sorted")
    spark.range(60_000).selectExpr("if(id < 50000, 7, id) as k", "id as v").coalesce(1).sort(
        "k"
    ).write.parquet(path)
    table = spark.read.parquet(path)
    hot = table.where("k = 7").select(skew.row_salt(table, 20).alias("salt"))
    used = Counter(r.salt for r in hot.collect())
    assert len(used) == 20 and max(used.values()) < 2 * 50_000 / 20
    small = spark.createDataFrame([(7, "hot"), (51_000, "rest")], "k long, name string")
    for how in ("inner", "left"):
        got = skew.join_hot_split(table, small, ["k"], how, 0.1)
        assert rows_of(got) == rows_of(table.join(small, ["k"], how).select(got.columns))
    plan = skew.join_hot_split(table, small, ["k"], "inner", 0.1)
    shown = plan._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Relation \[k#\d+L,v#", shown)) == 1


def test_state_keeps_large_integers_and_other_key_types(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [("a", 9007199254740993), ("a", None), ("b", None)]
    spark.createDataFrame(rows, "k string, v long").coalesce(1).write.parquet(path)
    from tidemill.streaming import runner

    read = spark.readStream.schema("k string, v long").parquet(path)
    totals = runner.updated(state.running_totals(read, "k", "v"), ["k", skew.SALT], "t")
    got = {tuple(r) for r in state.merged_totals(totals, "k").collect()}
    assert got == {("a", 2, 9007199254740993), ("b", 1, 0)}


def test_totals_are_kept_per_bucket_and_added_up_before_the_shuffle(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [(n % 50 or None, 1) for n in range(4000)]
    spark.createDataFrame(rows, "k long, v long").coalesce(1).write.parquet(path)
    from tidemill.streaming import runner

    read = spark.readStream.schema("k long, v long").parquet(path)
    states = runner.updated(state.running_totals(read, "k", "v", buckets=4, most=20), ["k", skew.SALT], "t").collect()
    assert {r[skew.SALT] for r in states} == {0, 1, 2, 3}  # not a state for every key
    assert sorted((r.k or 0, r.cnt, r.total) for r in states) == [(n, 80, 80) for n in range(50)]


def test_upsert_of_a_missing_key(spark):
    base = spark.createDataFrame([(None, "old"), (1, "one")], "k int, v string")
    changes = spark.createDataFrame([(None, "new", 1)], "k int, v string, seq int")
    assert rows_of(keyed.upsert(base, changes, ["k"], "seq")) == ["(1, 'one')", "(None, 'new')"]


def test_upsert_follows_a_key_that_moves(spark, tmp_path):
    path = str(tmp_path / "base")
    rows = [(1, "a", "A"), (2, "b", "B"), (3, "c", "B"), (None, "n", "N o")]
    spark.createDataFrame(rows, "k int, v string, part string").write.partitionBy("part").parquet(path)
    changes = spark.createDataFrame(
        [(1, "z", "B", 1), (None, "m", "B", 1)], "k int, v string, part string, seq int"
    )
    want = ["(1, 'z', 'B')", "(2, 'b', 'B')", "(3, 'c', 'B')", "(None, 'm', 'B')"]
    for _ in range(2):
        keyed.upsert_partitions(path, changes, ["k"], "seq", "part")
        assert rows_of(spark.read.parquet(path).select("k", "v", "part")) == want


def test_a_batch_that_has_become_empty(spark, tmp_path):
    path, df = str(tmp_path / "out"), spark.createDataFrame([(1,), (2,)], "v int")
    keyed.write_batch(df, 1, path)
    keyed.write_batch(df, 2, path)
    keyed.write_batch(df.limit(0), 1, path)
    assert rows_of(spark.read.parquet(path).select("v", "batch_id")) == ["(1, 2)", "(2, 2)"]


def test_results_belong_to_one_checkpoint(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(6).selectExpr("id as event_id").repartition(3).write.parquet(path)
    results, log = str(tmp_path / "r"), str(tmp_path / "o")

    def run(checkpoint):
        read = spark.readStream.schema("event_id long").parquet(path)
        delivery.deliver_once(read, results, log, str(tmp_path / checkpoint),
                              lambda f: f.agg(F.max("event_id").alias("offset")))

    run("one")
    run("one")
    with pytest.raises(ValueError, match="another checkpoint"):
        run("two")
    assert spark.read.parquet(results).count() == 6


def test_row_writer_leaves_no_half_file(spark, tmp_path):
    folder = str(tmp_path / "rows")
    row = spark.createDataFrame([(1,)], "v int").first()
    for error in (RuntimeError("lost"), None, None):
        writer = FileWriterPerTask(spark, folder)
        assert writer.open(0, 3)
        writer.process(row)
        writer.close(error)
        assert not [p for p in (tmp_path / "rows").iterdir() if p.name.startswith(".")] or error
    assert [p.name for p in (tmp_path / "rows").glob("[!.]*")] == ["00000003-000000.json"]
    assert open_store("file:///tmp")[1] == "/tmp"
    with pytest.raises(ValueError, match="no scheme"):
        open_store("/tmp")


def test_paths_and_sizes(spark, tmp_path):
    assert qualified(spark, str(tmp_path)).startswith("file:/")
    assert work_path(spark, "x") != work_path(spark, "x")
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    assert folder_bytes(spark, str(tmp_path / "t")) > 0 == folder_bytes(spark, str(tmp_path / "u"))
    huge = cluster_conf(10**14, 4000)
    assert int(huge["spark.sql.shuffle.partitions"]) == 50_000
    assert set(SCHEMAS) >= {"events", "documents"}


FOREIGN = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from tidemill.session import build_session
spark = build_session("foreign", "local[2]", {{"spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": {shared!r}, "spark.sql.warehouse.dir": {shared!r} + "/w"}})
spark.sparkContext.setLogLevel("OFF")
for name in ("udf_dsl", "stream_foreach", "stream_custom_source"):
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_workers_get_the_package(tmp_path):
    """From another working folder, with the repository on the driver's path alone."""
    import os

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = FOREIGN.format(repo=repo, shared=str(tmp_path / "shared"))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
        timeout=300,
    )
    counts = [line for line in done.stdout.splitlines() if line.split()[0] in code]
    assert len(counts) == 3, done.stderr[-2000:]
    assert not list((tmp_path / "shared").glob("run-*"))


def test_state_partitions_follow_the_input_on_a_cluster(spark, tmp_path):
    from types import SimpleNamespace

    from tidemill.session import STATE_PARTITIONS, size_states
    from tidemill.streaming.runner import PARTITIONS, stream_conf

    values = {PARTITIONS: "200"}
    conf = SimpleNamespace(get=lambda k, d=None: values.get(k, d), set=values.__setitem__, unset=values.pop)
    context = SimpleNamespace(master="spark://far:7077", defaultParallelism=12)
    cluster = SimpleNamespace(sparkContext=context, conf=conf, _jvm=spark._jvm, _jsc=spark._jsc)
    size_states(cluster, str(tmp_path))
    for sized, given, wanted in ((values[STATE_PARTITIONS], None, "12"), ("900", None, "200"), ("900", 7, "7")):
        values[STATE_PARTITIONS] = sized
        with stream_conf(cluster, given):
            assert values[PARTITIONS] == wanted
        assert values[PARTITIONS] == "200"
