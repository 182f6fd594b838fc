"""Equivalences, properties and edge cases of joins, aggregates, sampling, set operations."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidemill.operators.aggregates import first_per_key, item_sets, observed
from tidemill.operators.joins import cogroup_beside, cogroup_chunks, except_rows, map_side_join, pair_with_all
from tidemill.operators.ordering import listed_order, zip_with_index
from tidemill.operators.partitions import partition_batches, sorted_within, steps_back
from tidemill.operators.sampling import cut_point, hash_fraction, hash_split, hash_take
from tidemill.plans.bounds import checked_broadcast, measured_bytes
from tidemill.plans.skew import (
    agg_salted, hot_keys, join_full_split, join_hot_split, join_salted)
from tidemill.functions.userdefined import count_by_batches
from tidemill.session import cluster_conf, materialize


def rows_of(df):
    return sorted(str(tuple(r)) for r in df.collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 1 holds a third of the rows; NULL keys occur on both sides."""
    rng = random.Random(5)
    left = [(1 if i % 3 == 0 else rng.choice([None, *range(2, 40)]), i) for i in range(3000)]
    right = [(k, f"n{k}") for k in [None, *range(0, 30)]] + [(1, "again")]
    return (spark.createDataFrame(left, "k int, a int").repartition(8),
            spark.createDataFrame(right, "k int, b string"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_and_split_joins_equal_the_plain_join(skewed, how):
    left, right = skewed
    plain = rows_of(left.join(right, "k", how))
    assert rows_of(join_salted(left, right, ["k"], how)) == plain
    assert rows_of(join_hot_split(left, right, ["k"], how, fraction=0.05)) == plain


def test_hot_keys_are_few(skewed):
    assert [r.k for r in hot_keys(skewed[0], ["k"], 0.1).collect()] == [1]


def test_salted_join_refuses_right_joins(skewed):
    with pytest.raises(ValueError):
        join_salted(*skewed, ["k"], "right")


def test_full_join_in_two_parts(skewed):
    left, right = skewed
    want = left.join(right, "k", "full").select("k", "a", "b")
    assert rows_of(join_full_split(left, right, ["k"]).select("k", "a", "b")) == rows_of(want)


def test_semi_and_anti_cover_the_left_side(skewed):
    left, right = skewed
    semi, anti = left.join(right, "k", "left_semi"), left.join(right, "k", "left_anti")
    assert semi.count() + anti.count() == left.count()
    assert anti.filter(F.col("k").isNull()).count() == left.filter(F.col("k").isNull()).count()


def test_join_strategies_agree(skewed):
    left, right = skewed
    plain = rows_of(left.join(right, "k"))
    for frame in (right.hint("merge"), right.hint("shuffle_hash"), checked_broadcast(right)):
        assert rows_of(left.join(frame, "k")) == plain


def test_broadcast_only_below_the_bound(spark, skewed):
    left, right = skewed
    # a row of a hash table: its own width, eight bytes for each column, and the text
    assert measured_bytes(right) == sum(64 + 2 * 8 + len(r.b) for r in right.collect())
    plan = left.join(checked_broadcast(right, max_bytes=10), "k")
    assert "ResolvedHint" not in plan._jdf.queryExecution().analyzed().toString()
    hinted = left.join(checked_broadcast(right), "k")
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()


def test_map_side_join_default(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    small = spark.createDataFrame([(1, "one")], "k int, name string")
    assert rows_of(map_side_join(left, small, "k", "name")) == ["(1, 'one')", "(2, '')", "(None, '')"]


def test_pair_with_all_refuses_a_large_side(spark, skewed):
    assert pair_with_all(spark.range(4), spark.range(3).withColumnRenamed("id", "x")).count() == 12
    with pytest.raises(ValueError):
        pair_with_all(spark.range(4), spark.range(50).withColumnRenamed("id", "x"), max_bytes=10)


def test_cogroup_chunks(spark):
    left = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (2, 9)], "k int, v int")
    right = spark.createDataFrame([(1, 7), (3, 8)], "k int, w int")
    got = cogroup_chunks(left, right, "k", "v", "w", chunk_rows=2)
    assert {(r.k, r.side, r.chunk): r["items"] for r in got.collect()} == {
        (1, "left", 0): [1, 2], (1, "left", 1): [3], (2, "left", 0): [9],
        (1, "right", 0): [7], (3, "right", 0): [8]}


def test_cogroup_beside_joins_the_sides(spark):
    left = spark.createDataFrame([(1, 3), (1, 1), (1, 2), (2, 9)], "k int, v int")
    right = spark.createDataFrame([(1, 7), (3, 8)], "k int, w int")
    got = {(r.k, r.chunk): (r.left_items, r.right_items)
           for r in cogroup_beside(left, right, "k", "v", "w", chunk_rows=2).collect()}
    assert got == {(1, 0): ([1, 2], [7]), (1, 1): ([3], None), (2, 0): ([9], None),
                   (3, 0): (None, [8])}


def test_cogroup_query_has_both_sides_in_a_row(spark, small):
    from tidemill.registry import all_queries

    got = all_queries()["cogroup"].build(small)
    assert got.columns == ["key", "chunk", "left_items", "right_items"]
    assert got.where("left_items is not null and right_items is not null").count() > 0


def test_repartition_counts_names_the_partitions(small):
    from tidemill.registry import all_queries

    got = all_queries()["repartition_counts"].build(small)
    assert [tuple(r) for r in got.collect()] == [(4, small.orders.count())]


def test_steps_back_counts_rows_out_of_order(spark):
    rows = [(None, 5), (None, 9), (1, None), (1, 2), (1, 1), (3, 0), (2, 7), (2, 7), (2, None)]
    frame = spark.createDataFrame(rows, "a long, b long").coalesce(1)
    for size in (1, 2, 100):  # rows of a batch: the last one is carried on
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = steps_back(frame, ["a", "b"]).groupBy().sum("back", "rows").first()
            sorted_too = steps_back(frame.sortWithinPartitions("a", "b"), ["a", "b"])
            assert tuple(got) == (3, 9)
            assert sorted_too.groupBy().sum("back").first()[0] == 0
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert steps_back(frame.where("a > 9"), ["a", "b"]).count() == 0


def test_cogroup_function_gets_a_row_of_a_key(spark, monkeypatch):
    from types import SimpleNamespace

    from tidemill.operators import joins
    from tidemill.registry import all_queries

    sides = []

    def watched(left, right, *rest, apply=joins.cogroup_apply):
        sides.extend((left, right))
        return apply(left, right, *rest)

    monkeypatch.setattr(joins, "cogroup_apply", watched)
    hot = F.when(F.col("id") < 400, 1).otherwise(F.col("id"))
    price = F.when(F.col("id") != 7, F.lit(2.5))
    tables = SimpleNamespace(
        orders=spark.range(500).select(hot.alias("o_custkey"), price.alias("o_totalprice")),
        events=spark.range(450).select((hot + 10).alias("user_id"), F.col("id").alias("event_id")),
    )
    got = {r.key: tuple(r)[1:] for r in all_queries()["cogroup_function"].build(tables).collect()}
    assert got[1] == (400, 0, 997.5) and got[11] == (0, 400, 0.0)
    assert got[410] == (1, 1, 2.5) and got[405] == (1, 0, 2.5) and len(got) == 102
    for side in sides:
        assert side.groupBy("key").count().where("count > 1").count() == 0


def test_cogroup_takes_keys_by_the_bucket(spark, tmp_path):
    from tidemill.operators.joins import cogroup_apply
    from tidemill.queries.checks import orders_and_events

    calls = str(tmp_path)

    def noted(orders, events):
        import uuid

        open(f"{calls}/{uuid.uuid4().hex}", "w").close()
        return orders_and_events(orders, events)

    large = 2**62 + 1  # would lose digits as a float beside a missing key
    left = spark.range(600).selectExpr("id as key", "id as orders", "if(id % 3 = 0, null, id * 0.5d) as spent")
    left = left.union(spark.createDataFrame([(None, 7, 1.0), (large, 1, float("nan"))], "key long, orders long, spent double"))
    right = spark.range(400, 1000).selectExpr("id as key", "1L as events")
    right = right.union(spark.createDataFrame([(None, 5), (large, 2)], "key long, events long"))
    schema = "key long, orders long, events long, spent double"
    got = {r.key: tuple(r)[1:] for r in cogroup_apply(left, right, "key", noted, schema, 20).collect()}
    assert len(got) == 1002 and len(list(tmp_path.iterdir())) <= 20
    assert got[None] == (7, 5, 1.0) and got[large] == (1, 2, 0.0)
    assert got[1] == (1, 0, 0.5) and got[3] == (3, 0, 0.0) and got[500] == (500, 1, 250.0) and got[999] == (0, 1, 0.0)
    one_side = cogroup_apply(left.where("key < 0"), right, "key", orders_and_events, schema, 3)
    assert one_side.count() == 602
    assert cogroup_apply(left, right.where("key < 0"), "key", orders_and_events, schema).count() == 602


def test_salted_aggregate_equals_plain(skewed):
    left = skewed[0]
    spec = {"n": ("count", F.col("a")), "s": ("sum", F.col("a")), "m": ("avg", F.col("a")),
            "lo": ("min", F.col("a")), "hi": ("max", F.col("a"))}
    plain = left.groupBy("k").agg(F.count("a"), F.sum("a"), F.avg("a"), F.min("a"), F.max("a"))
    for salts in (1, 8):
        assert rows_of(agg_salted(left, ["k"], spec, salts)) == rows_of(plain)


def test_union_counts_add_up(skewed):
    a = skewed[0]
    assert a.union(a).count() == 2 * a.count()


def test_except_forms(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (3,)], "k int")
    right = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows_of(except_rows(left, right)) == ["(1,)", "(1,)", "(3,)"]
    assert rows_of(left.subtract(right)) == ["(1,)", "(3,)"]


def test_first_per_key_and_item_sets(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (1, 3, "c"), (2, 1, "z")],
                               "k int, o int, v string")
    assert rows_of(first_per_key(df, ["k"], ["o", "v"])) == ["(1, 3, 'a')", "(2, 1, 'z')"]
    assert rows_of(item_sets(df, "k", "v")) == ["(1, ['a', 'b', 'c'])", "(2, ['z'])"]


def test_observation_counts_rejects(spark):
    df = spark.createDataFrame([("1",), ("x",), ("2",)], "v string")
    parsed = df.select(F.col("v").try_cast("int").alias("n"))
    watched, seen = observed(parsed, bad=F.count_if(F.col("n").isNull()), all=F.count(F.lit(1)))
    watched.collect()
    assert seen.get == {"bad": 1, "all": 3}


def test_summary(small):
    table = {r["summary"]: r["l_quantity"] for r in small.lineitem.describe("l_quantity").collect()}
    assert table["count"] == "6000" and float(table["min"]) == 1.0


def test_samples_do_not_depend_on_partitions(small):
    events = small.events.select("event_id")
    for frame in (lambda d: hash_fraction(d, ["event_id"], 0.3, 1),
                  lambda d: hash_take(d, ["event_id"], 40, 1),
                  lambda d: hash_split(d, ["event_id"], [3, 1], 1)):
        assert rows_of(frame(events)) == rows_of(frame(events.repartition(5)))


def test_sample_sizes(small):
    events = small.events.select("event_id")
    n = events.count()
    assert 0.2 * n < hash_fraction(events, ["event_id"], 0.3, 1).count() < 0.4 * n
    assert hash_take(events, ["event_id"], 40, 1).count() == 40
    assert hash_take(events, ["event_id"], 10**6, 1).count() == n
    parts = hash_split(events, ["event_id"], [8, 2], 3).groupBy("part").count().collect()
    assert sum(r["count"] for r in parts) == n
    assert {r.part for r in parts} == {0, 1}
    assert cut_point(0) == "00000000" and cut_point(1) == "g"


def test_sample_with_replacement_repeats_rows(small):
    drawn = small.events.select("event_id").sample(True, 2.0, seed=3)
    assert drawn.count() > drawn.distinct().count()


def test_random_split_covers_all(small):
    parts = small.events.randomSplit([9.0, 1.0], seed=2)
    assert sum(p.count() for p in parts) == small.events.count()


def test_zip_index_in_blocks(small):
    events = small.events.select("event_id", "ts")
    plain = zip_with_index(events, ["ts", "event_id"])
    blocked = zip_with_index(events, ["ts", "event_id"], rows_per_task=100)
    assert rows_of(plain) == rows_of(blocked)


def test_zip_with_index_of_an_rdd_agrees(small):
    events = small.events.select("event_id", "ts")
    by_rdd = events.orderBy("ts", "event_id").rdd.zipWithIndex().map(lambda p: (p[0][0], p[1]))
    frame = zip_with_index(events, ["ts", "event_id"]).select("event_id", "index")
    assert sorted(by_rdd.collect()) == sorted(map(tuple, frame.collect()))


def test_listed_order(spark):
    df = spark.createDataFrame([("b",), ("c",), ("a",), (None,)], "v string")
    assert [r.v for r in df.orderBy(listed_order("v", ["c", "a"]), "v").collect()] == [
        "c", "a", None, "b"]


def test_sorted_within_partitions(small):
    placed = sorted_within(small.orders.select("o_custkey", "o_orderkey"), 4, ["o_custkey"],
                           ["o_custkey", "o_orderkey"])
    for part in placed.rdd.glom().collect():
        assert part == sorted(part)


def test_partition_functions(small):
    assert rows_of(count_by_batches(small.events, "event_type")) == rows_of(
        small.events.groupBy("event_type").agg(F.count(F.lit(1))))
    passed = partition_batches(small.region, lambda batches: batches, small.region.schema)
    assert rows_of(passed) == rows_of(small.region)


def test_take_and_actions(small):
    ordered = small.orders.orderBy("o_orderkey")
    assert ordered.first().o_orderkey == ordered.head().o_orderkey == ordered.take(1)[0].o_orderkey
    by_key = {r.n_nationkey: r.n_name for r in small.nation.collect()}
    assert len(by_key) == 25
    pairs = small.nation.rdd.map(lambda r: (r.n_regionkey, 1))
    assert sum(pairs.countByKey().values()) == 25


def test_cache_checkpoint_and_written_cut(spark, small):
    events = small.events.groupBy("event_type").count()
    want = rows_of(events)
    held = events.persist()
    assert rows_of(held) == want
    held.unpersist()
    assert rows_of(events.checkpoint()) == want
    assert rows_of(materialize(events)) == want


def test_views_and_catalog(spark, small):
    name = f"v_{uuid.uuid4().hex[:8]}"
    small.nation.createOrReplaceTempView(name)
    small.nation.createGlobalTempView(name)
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 25
    other = spark.newSession()
    assert other.sql(f"SELECT count(*) FROM global_temp.{name}").first()[0] == 25
    assert name in [t.name for t in spark.catalog.listTables()]
    spark.catalog.cacheTable(name)
    assert spark.catalog.isCached(name)
    spark.catalog.uncacheTable(name)
    assert "default" in [r[0] for r in spark.sql("SHOW DATABASES").collect()]
    assert small.nation.dtypes[0] == ("n_nationkey", "int")
    assert small.nation.columns == ["n_nationkey", "n_name", "n_regionkey"]


@pytest.mark.parametrize("size,cores,partitions,split", [
    (0, 8, 8, "128m"), (1024**4, 4000, 8192, "128m"), (100 * 1024**4, 4000, 50000, "1024m")])
def test_settings_follow_input_and_cluster(size, cores, partitions, split):
    assert cluster_conf(size, cores) == {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": split}
