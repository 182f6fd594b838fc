"""Files, tables, JDBC and Kafka options, keyed sinks."""

import datetime
import uuid

import pytest
from pyspark.sql import functions as F

from tidemill.sinks import files as sinks
from tidemill.sinks import keyed
from tidemill.sources import files, jdbc, kafka
from tidemill.streaming import offsets


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_positional_csv_turns_bad_text_into_null(spark, tmp_path):
    (tmp_path / "a.csv").write_text("1,2.5,x\nno,3.5,y\n4,,z\n")
    df = files.read_csv_positional(spark, str(tmp_path), "a int, b double, c string")
    assert rows_of(df) == ["(1, 2.5, 'x')", "(4, None, 'z')", "(None, 3.5, 'y')"]


def test_inferred_and_declared_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a;b\n1;x\n2;y\n")
    inferred = files.read_csv_inferred(spark, str(tmp_path), ";")
    assert inferred.dtypes == [("a", "int"), ("b", "string")]
    declared = files.read_csv(spark, str(tmp_path), "a bigint, b string", sep=";")
    assert declared.dtypes[0] == ("a", "bigint") and declared.count() == 2


def test_json_lines_and_multiline(spark, tmp_path):
    (tmp_path / "lines").mkdir()
    (tmp_path / "lines" / "a.json").write_text('{"name":"Tom","age":3}\n{"name":"Ann"}\n')
    (tmp_path / "whole").mkdir()
    (tmp_path / "whole" / "a.json").write_text('[{"name":"Tom",\n"age":3}]')
    schema = "name string, age int"
    assert rows_of(files.read_json(spark, str(tmp_path / "lines"), schema)) == [
        "('Ann', None)", "('Tom', 3)"]
    assert rows_of(files.read_json(spark, str(tmp_path / "whole"), schema, multiline=True)) == [
        "('Tom', 3)"]


def test_delimited_text(spark, tmp_path):
    (tmp_path / "u.data").write_text("196\t242\t3.0\n186 302  4.5\n")
    df = files.read_delimited_text(spark, str(tmp_path), "user int, item int, rating double")
    assert rows_of(df) == ["(186, 302, 4.5)", "(196, 242, 3.0)"]


def test_rows_and_rdd_with_schema(spark):
    rows = [("Jack", 28), ("Tom", 10)]
    a = files.rows_with_schema(spark, rows, "name string, age int")
    b = spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), a.schema)
    assert rows_of(a) == rows_of(b)
    assert a.first()["name"] == a.first()[0] == a.first().name


def test_numeric_range(spark):
    assert [r.id for r in spark.range(5, 100, 5).collect()] == list(range(5, 100, 5))


def test_save_modes(spark, small, tmp_path):
    path = str(tmp_path / "nation")
    small.nation.write.save(path)
    with pytest.raises(Exception, match="already exists"):
        small.nation.write.save(path)
    small.nation.write.mode("append").save(path)
    assert spark.read.load(path).count() == 50
    small.nation.write.mode("overwrite").save(path)
    assert spark.read.load(path).count() == 25


def test_text_goes_into_one_file_only_if_it_fits(spark, small, tmp_path, monkeypatch):
    assert sinks.write_text(small.part, "p_name", str(tmp_path / "one")) == 1
    monkeypatch.setattr(sinks, "FILE_BYTES", 500)
    assert sinks.write_text(small.part.repartition(8), "p_name", str(tmp_path / "more")) > 1
    assert spark.read.text(str(tmp_path / "more")).count() == small.part.count()


def test_sequence_and_object_files(spark, small, tmp_path):
    sinks.save_sequence(small.nation, "n_nationkey", "n_name", str(tmp_path / "seq"))
    pairs = spark.sparkContext.sequenceFile(str(tmp_path / "seq")).collect()
    assert sorted(pairs) == sorted((r.n_nationkey, r.n_name) for r in small.nation.collect())
    sinks.save_objects(small.region, str(tmp_path / "obj"))
    back = spark.sparkContext.pickleFile(str(tmp_path / "obj")).collect()
    assert sorted(back) == sorted(map(tuple, small.region.collect()))


def test_insert_is_by_position_and_keeps_other_partitions(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    sinks.create_table(df, name, str(tmp_path / "t"), ["p"])
    before = spark.conf.get(sinks.OVERWRITE_MODE)
    spark.conf.set(sinks.OVERWRITE_MODE, "static")
    try:
        sinks.replace_partitions(spark.createDataFrame([("a", 9)], "p string, v int"), name)
        assert spark.conf.get(sinks.OVERWRITE_MODE) == "static"
    finally:
        spark.conf.set(sinks.OVERWRITE_MODE, before)
    assert rows_of(spark.table(name)) == ["(2, 'b')", "(9, 'a')"]


def test_range_predicates_cover_each_value_once(spark):
    for low, high, parts in [(1, 100, 7), (0, 2, 5), (-3, 3, 2), (5, 5, 1)]:
        tests = jdbc.range_predicates("id", low, high, parts)
        seen = spark.range(low - 5, high + 6)
        hits = sum((F.expr(p).cast("int") for p in tests), F.lit(0))
        for r in seen.select("id", hits.alias("n")).collect():
            assert r.n == (1 if low <= r.id <= high else 0)


def test_jdbc_options():
    options = jdbc.connection("jdbc:x:y", "t", "u", "p", "d")
    assert options["dbtable"] == "t"
    assert jdbc.partitioning("id", 1, 9, 3) == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "9", "numPartitions": "3"}


def test_kafka_options(spark):
    by_topic = kafka.source_options("h:1", topics=["a", "b"], starting="earliest", max_offsets=10)
    assert by_topic == {"kafka.bootstrap.servers": "h:1", "startingOffsets": "earliest",
                        "subscribe": "a,b", "maxOffsetsPerTrigger": "10"}
    assert kafka.source_options("h:1", pattern="t.*", ending="latest")["endingOffsets"] == "latest"
    assert kafka.source_options("h:1", assign={"a": [0, 1]}, min_partitions=9) == {
        "kafka.bootstrap.servers": "h:1", "startingOffsets": "latest", "minPartitions": "9",
        "assign": '{"a": [0, 1]}'}
    with pytest.raises(ValueError):
        kafka.source_options("h:1")
    with pytest.raises(ValueError):
        kafka.source_options("h:1", topics=["a"], pattern="b")
    assert kafka.offsets_json({("t", 1): kafka.LATEST, ("t", 0): kafka.EARLIEST}) == (
        '{"t": {"0": -2, "1": -1}}')
    assert kafka.sink_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}
    stored = spark.createDataFrame([("t", 0, 5)], "topic string, part int, offset bigint")
    assert kafka.starting_offsets(stored) == '{"t": {"0": 5}}'
    assert kafka.starting_offsets(stored.limit(0)) == "earliest"


def test_kafka_payload_and_decode(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    sent = kafka.payload(df, "id", ["id", "v"], F.concat(F.lit("topic"), "id"))
    assert rows_of(sent) == ["""('1', '{"id":1,"v":"a"}', 'topic1')""",
                             """('2', '{"id":2}', 'topic2')"""]
    raw = sent.select(F.col("key").cast("binary"), F.col("value").cast("binary"), "topic")
    assert rows_of(kafka.decode(raw)) == rows_of(sent)


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    changes = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (4, "new", 1)],
                                    "k int, v string, seq int")
    want = ["(1, 'a')", "(2, 'y')", "(3, 'c')", "(4, 'new')"]
    once = keyed.upsert(base, changes, ["k"], "seq")
    assert rows_of(once) == want
    assert rows_of(keyed.upsert(once, changes, ["k"], "seq")) == want


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "base")
    base = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, v string, part string")
    base.write.partitionBy("part").parquet(path)
    kept = {f for f in spark.read.parquet(path).inputFiles() if "part=q" in f}
    changes = spark.createDataFrame([(1, "z", "p", 1)], "k int, v string, part string, seq int")
    for _ in range(2):
        keyed.upsert_partitions(path, changes, ["k"], "seq", "part")
    after = spark.read.parquet(path)
    assert rows_of(after.select("k", "v", "part")) == ["(1, 'z', 'p')", "(2, 'b', 'q')"]
    assert kept <= set(after.inputFiles())


def test_batches_and_stages_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1,), (2,)], "v int")
    for batch in (1, 2, 2):
        keyed.write_batch(df, batch, path)
    assert spark.read.parquet(path).count() == 4
    stage, target = str(tmp_path / "stage"), str(tmp_path / "target")
    for batch in (1, 1, 2):
        keyed.staged_append(df, batch, stage, target)
    assert spark.read.parquet(target).count() == 4
    assert spark.read.schema("v int").parquet(stage).count() == 0


def test_metric_store_keeps_live_rows_and_versions(spark):
    now = datetime.datetime(2020, 1, 2, 12)
    rows = [("m", now - datetime.timedelta(hours=h), h) for h in (0, 23, 24, 25)]
    rows += [("n", now, v) for v in range(15)]
    df = spark.createDataFrame(rows, "event string, ts timestamp, value int")
    stored = keyed.metric_rows(df, F.col("event"), "ts", F.col("value"))
    live = keyed.live_metrics(stored, F.lit(now))
    assert sorted(r.value for r in live.filter("event = 'm'").collect()) == [0, 23, 24]
    assert sorted(r.value for r in live.filter("event = 'n'").collect()) == list(range(5, 15))


BOUNDS = [("t", p, 100, 500) for p in range(6)] + [("only_bounds", 0, 7, 9)]
STORED = [("t", 0, 50), ("t", 1, 100), ("t", 2, 300), ("t", 3, 500), ("t", 4, 900),
          ("only_store", 0, 3)]


def test_offset_clamp(spark):
    bounds = spark.createDataFrame(BOUNDS, "topic string, part int, low bigint, high bigint")
    stored = spark.createDataFrame(STORED, "topic string, part int, offset bigint")
    got = {(r.topic, r.part): r.start_offset for r in offsets.clamp(stored, bounds).collect()}
    assert got == {("t", 0): 100, ("t", 1): 100, ("t", 2): 300, ("t", 3): 500, ("t", 4): 500,
                   ("t", 5): 100, ("only_bounds", 0): 7}


def test_latest_offsets_group_and_ties(spark):
    t = [datetime.datetime(2020, 1, d) for d in (1, 2)]
    log = spark.createDataFrame(
        [("g", "t", 0, 9, t[0]), ("g", "t", 0, 5, t[1]), ("g", "t", 0, 6, t[1]),
         ("h", "t", 0, 1, t[0])], "grp string, topic string, part int, offset bigint, ts timestamp")
    assert rows_of(offsets.latest_offsets(log)) == ["('g', 't', 0, 6)", "('h', 't', 0, 1)"]


def test_rejects_are_counted_and_kept(spark):
    """Hours beyond the day, as in the worked example's file; NULL and empty texts."""
    texts = spark.createDataFrame(
        [("1", "2019-04-12 25:31:00"), ("x", "2019-04-12 23:31:00"), (None, None), ("", "31"), ("7", "2019-04-12 31:00:01")],
        "n string, ct string",
    )
    schema, formats = "n int, ct timestamp_ntz", {"ct": "yyyy-MM-dd HH:mm:ss"}
    good = files.typed(texts, schema, formats)
    assert good.where("ct is not null").count() == 1 and good.where("n is not null").count() == 2
    counts = {r["column"]: (r.present, r.rejected) for r in files.reject_counts(texts, schema, formats).collect()}
    assert counts == {"n": (4, 2), "ct": (4, 3)}
    bad = sorted((r.n, r.ct, tuple(r.faults)) for r in files.rejected_rows(texts, schema, formats).collect())
    assert bad == [
        ("", "31", ("n", "ct")),
        ("1", "2019-04-12 25:31:00", ("ct",)),
        ("7", "2019-04-12 31:00:01", ("ct",)),
        ("x", "2019-04-12 23:31:00", ("n",)),
    ]
    none = files.reject_counts(texts.limit(0), schema, formats)
    assert {(r.present, r.rejected) for r in none.collect()} == {(0, 0)}
