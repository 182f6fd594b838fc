"""Worked examples with known results."""

import datetime

import pytest
from pyspark.sql import functions as F

from tidemill.functions import dates, jsons, text, userdefined
from tidemill.operators.aggregates import integer_mean, two_level
from tidemill.operators.columns import lookup, recode
from tidemill.operators.partitions import by_rule, partition_sizes
from tidemill.plans import analyses, points


def day(s):
    return datetime.date.fromisoformat(s)


def as_dict(df):
    return {r[0]: r[1] for r in df.collect()}


@pytest.mark.parametrize("repeat", [False, True])
def test_login_streak(spark, repeat):
    rows = [(1, "2019-08-01"), (1, "2019-08-02"), (1, "2019-08-03"), (2, "2019-08-01"),
            (2, "2019-08-02"), (3, "2019-08-01"), (3, "2019-08-03"), (4, "2019-07-28"),
            (4, "2019-07-29"), (4, "2019-08-01"), (4, "2019-08-02"), (4, "2019-08-03")]
    if repeat:
        rows.append((1, "2019-08-02"))
    df = spark.createDataFrame([(u, day(d)) for u, d in rows], "uid int, date date")
    got = as_dict(analyses.longest_streaks(df, "uid", "date"))
    assert got == {1: 3, 2: 2, 3: 1, 4: 3}


def test_split_list_cell(spark):
    df = spark.createDataFrame([(30, "Tom, Andy, Jack"), (20, "Pand, Gate, Sundy")],
                               "age int, names string")
    rows = df.select("age", F.explode(text.cell_items("names")).alias("name")).collect()
    assert sorted(map(tuple, rows)) == sorted(
        [(30, "Tom"), (30, "Andy"), (30, "Jack"), (20, "Pand"), (20, "Gate"), (20, "Sundy")])


WORDS = [(1, "i|love|china"), (2, "china|is|good|i|i|like")]
WORD_ROWS = {(1, "i", 1), (1, "love", 1), (1, "china", 1), (2, "is", 1), (2, "china", 1),
             (2, "i", 2), (2, "good", 1), (2, "like", 1)}


def test_words_per_uid(spark):
    df = spark.createDataFrame(WORDS, "uid int, contents string")
    rows = analyses.words_by_key(df, "uid", "contents", r"\|").collect()
    assert {tuple(r) for r in rows} == WORD_ROWS and len(rows) == 8


def test_words_per_uid_table_function(spark):
    userdefined.register(spark)
    df = spark.createDataFrame(WORDS, "uid int, contents string")
    rows = spark.sql("SELECT uid, word, cnt FROM {df}, LATERAL words_of_cell(contents)", df=df)
    assert {tuple(r) for r in rows.collect()} == WORD_ROWS


SCORES = [("001", "语文", 90.0), ("001", "数学", 91.0), ("001", "英语", 80.0),
          ("002", "语文", 88.0), ("002", "数学", 90.0), ("002", "英语", 75.5),
          ("003", "语文", 70.0), ("003", "数学", 85.0), ("003", "英语", 90.0),
          ("003", "政治", 82.0)]
SUBJECTS = ["语文", "数学", "英语", "政治"]


@pytest.fixture(scope="module")
def scores(spark):
    return spark.createDataFrame(SCORES, "userid string, subject string, score double")


@pytest.mark.parametrize("pivot", [analyses.pivot_sums, analyses.pivot_when])
def test_score_pivot(scores, pivot):
    rows = pivot(scores, "userid", "subject", SUBJECTS, "score").collect()
    assert {tuple(r) for r in rows} == {("001", 90, 91, 80, 0), ("002", 88, 90, 75.5, 0),
                                        ("003", 70, 85, 90, 82)}


def test_score_totals(scores):
    rows = analyses.pivot_with_total(scores, "userid", "subject", SUBJECTS, "score").collect()
    assert {(r.userid, r.total) for r in rows} == {("001", 261), ("002", 253.5), ("003", 327),
                                                   ("total", 841.5)}
    line = next(r for r in rows if r.userid == "total")
    assert [line[s] for s in SUBJECTS] == [248, 266, 245.5, 82]


def test_totals_keep_a_null_user_apart(spark):
    df = spark.createDataFrame([(None, "a", 1.0), ("u", "a", 2.0)], "u string, t string, v double")
    rows = analyses.pivot_with_total(df, "u", "t", ["a"], "v").collect()
    assert sorted((str(r.u), r.total) for r in rows) == [("None", 1), ("total", 3), ("u", 2)]


def test_tags_to_labels(spark):
    lists = spark.createDataFrame([("1,2,3",), ("1,2",), ("2,3",)], "tags string")
    labels = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C")], "id string, lab string")
    got = as_dict(analyses.label_tags(lists, "tags", labels, "id", "lab"))
    assert got == {"1,2,3": "A,B,C", "1,2": "A,B", "2,3": "B,C"}


SALES = [(1, "Widget Co", 1000.0, 0.0, "AZ", "2014-01-01"),
         (2, "Acme Widgets", 2000.0, 500.0, "CA", "2014-02-01"),
         (3, "Widgetry", 1000.0, 200.0, "CA", "2015-01-11"),
         (4, "Widgets R Us", 2000.0, 0.0, "CA", "2015-02-19"),
         (5, "Ye Olde Widgete", 3000.0, 0.0, "MA", "2015-02-28")]


@pytest.mark.parametrize("partitions", [1, 2, 5])
def test_year_on_year(spark, partitions):
    df = spark.createDataFrame(
        SALES, "id int, name string, sales double, discount double, state string, saleDate string"
    ).repartition(partitions, "id")
    year = F.year(F.col("saleDate").cast("date"))
    assert df.agg(userdefined.growth(year, "sales", 2014, 2015)).first()[0] == 1.0
    assert df.agg(userdefined.growth_of(year, F.col("sales"))).first()[0] == 1.0


def test_two_level_max_then_sum(spark):
    rows = [(0, "a", 3), (0, "a", 2), (0, "c", 4), (1, "b", 3), (1, "c", 6), (1, "c", 8)]
    df = spark.createDataFrame(rows, "part int, key string, value int")
    assert as_dict(two_level(df, ["key"], "part", F.max, F.sum, "value", "v")) == {
        "a": 3, "b": 3, "c": 12}
    assert as_dict(df.groupBy("key").agg(F.sum("value"))) == {"a": 5, "b": 3, "c": 18}


def ticks(spark):
    first = [("09:00:10", 25.51), ("09:00:20", 25.72), ("09:00:30", 25.83), ("09:00:40", 25.94),
             ("09:00:50", 26.00), ("09:10:00", 25.98), ("15:00:00", 25.50)]
    second = [15.51, 15.72, 15.83, 15.94, 16.00, 25.98, 16.00]
    rows = [("sh600794", t, p) for t, p in first]
    rows += [("sh603066", t, p) for (t, _), p in zip(first, second)]
    return spark.createDataFrame(
        [(s, datetime.datetime.fromisoformat(f"2019-09-02T{t}"), p) for s, t, p in rows],
        "sid string, time timestamp_ntz, price double")


@pytest.mark.parametrize("rows_per_task", [1000, 3])
def test_peaks_and_troughs(spark, rows_per_task):
    df = ticks(spark).withColumn("day", F.col("time").cast("date"))
    found = analyses.peaks_and_troughs(df, ["sid", "day"], ["time"], "price", rows_per_task)
    assert {(r.sid, r.price, r.kind) for r in found.collect()} == {
        ("sh600794", 26.0, "peak"), ("sh603066", 25.98, "peak")}


def test_peaks_do_not_look_into_another_day(spark):
    rows = [("s", day("2019-09-02"), 1, 5.0), ("s", day("2019-09-02"), 2, 9.0),
            ("s", day("2019-09-03"), 3, 1.0), ("s", day("2019-09-03"), 4, 4.0)]
    df = spark.createDataFrame(rows, "sid string, day date, t int, price double")
    assert analyses.peaks_and_troughs(df, ["sid", "day"], ["t"], "price").count() == 0


def test_peaks_sql_text_gives_the_same(spark):
    sql = spark.sql(
        """SELECT sid, time, kind FROM (SELECT sid, time,
             CASE WHEN price > lag(price) OVER w AND price > lead(price) OVER w THEN 'peak'
                  WHEN price < lag(price) OVER w AND price < lead(price) OVER w THEN 'trough'
             END AS kind FROM {t} WINDOW w AS (PARTITION BY sid, date(time) ORDER BY time))
           WHERE kind IS NOT NULL""", t=ticks(spark))
    df = ticks(spark).withColumn("day", F.col("time").cast("date"))
    dsl = analyses.peaks_and_troughs(df, ["sid", "day"], ["time"], "price")
    assert sorted(sql.collect()) == sorted(dsl.select("sid", "time", "kind").collect())


@pytest.mark.parametrize("score,level", [
    (0, "普通"), (10, "普通"), (999, "普通"), (1000, "银牌"), (1005, "银牌"), (2999, "银牌"),
    (3000, "金牌"), (6900, "金牌"), (9999, "金牌"), (10000, "钻石")])
def test_levels(spark, score, level):
    df = spark.createDataFrame([(score,)], "s int")
    row = df.select(points.level_of("s"), userdefined.level_name("s")).first()
    assert tuple(row) == (level, level)


def test_action_time_rejects_hour_26(spark):
    df = spark.createDataFrame([("20190930260000",), ("20190930230000",)], "ct string")
    assert [r[0] is None for r in df.select(points.action_time("ct")).collect()] == [True, False]


def test_weekly_levels(spark):
    actions = spark.createDataFrame(
        [("A", "05", "2019-09-30 00:00:00"), ("A", "03", "2019-10-06 23:59:59"),
         ("A", "05", "2019-10-07 00:00:00"), ("B", "05", "2019-09-29 23:59:59"),
         ("C", "99", "2019-10-01 10:00:00")], "user string, action string, ct string"
    ).withColumn("ct", F.col("ct").cast("timestamp"))
    users = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "user string")
    table = spark.createDataFrame(list(points.ACTION_POINTS.items()), "action string, points int")
    monday = F.lit(day("2019-09-30"))
    got = points.weekly_levels(actions, table, "user", "action", "ct", monday, users).collect()
    listed = {("A", 7, "普通"), ("B", 0, "普通"), ("C", 0, "普通"), ("D", 0, "普通")}
    assert {(r.user, r.uscore, r.ulevel) for r in got} == listed
    acted = points.weekly_levels(actions, table, "user", "action", "ct", monday).collect()
    assert {(r.user, r.uscore, r.ulevel) for r in acted} == listed - {("D", 0, "普通")}


LINE = '8.35.201.160 - - [16/May/2018:{} +0800] "GET /uc_server/x.php HTTP/1.1" 200 5396'


@pytest.mark.parametrize("clock,utc_day", [
    ("17:38:21", "2018-05-16"), ("23:30:00", "2018-05-16"), ("05:00:00", "2018-05-15")])
def test_access_log(spark, clock, utc_day):
    df = spark.createDataFrame([(LINE.format(clock),)], "line string")
    row = df.select(text.log_ip("line"), text.log_day("line"),
                    text.log_instant("line").cast("date")).first()
    assert tuple(row) == ("8.35.201.160", day("2018-05-16"), day(utc_day))


def test_access_log_without_match(spark):
    df = spark.createDataFrame([("no log line",)], "line string")
    assert tuple(df.select(text.log_ip("line"), text.log_day("line")).first()) == ("", None)


def test_visitors_per_day(spark):
    rows = [("a", "2019-01-01"), ("a", "2019-01-01"), ("b", "2019-01-01"), ("a", "2019-01-02"),
            ("c", "2019-01-02")]
    df = spark.createDataFrame([(v, day(d)) for v, d in rows], "ip string, day date")
    got = analyses.page_and_visitor_counts(df, "ip", "day").orderBy("day").collect()
    assert [tuple(r)[1:] for r in got] == [(3, 2, 2), (2, 2, 1)]
    joined = analyses.counts_joined(df, "ip", "day").orderBy("day").collect()
    assert [tuple(r)[1:] for r in joined] == [(3, 2), (2, 2)]


def test_custom_partition_rule(spark):
    df = spark.createDataFrame([(k,) for k in (10, 2, 150, 560, 10, -500)], "k int")
    placed = by_rule(df, 2, F.when(F.col("k") > 100, 1).otherwise(0))
    assert as_dict(partition_sizes(placed)) == {0: 4, 1: 2}
    assert placed.rdd.glom().map(lambda p: sorted(r.k for r in p)).collect() == [
        [-500, 2, 10, 10], [150, 560]]


MESSAGE = ('"openid":"x1","phoneNum":"p1","money":"{}","date":"2018-09-13T02:15:16.054Z",'
           '"lat":39.688011,"log":116.066689')


def test_recharge_messages(spark):
    df = spark.createDataFrame([(MESSAGE.format(m),) for m in (100, 122)], "value string")
    picked = text.quoted_field("value", 11).try_cast("bigint")
    wrapped = F.get_json_object(F.concat(F.lit("{"), "value", F.lit("}")), "$.money")
    money = df.select(picked.alias("money"), wrapped.cast("bigint").alias("json_money"))
    row = money.agg(F.sum("money"), F.count("money"), integer_mean("money"), F.sum("json_money"))
    assert tuple(row.first()) == (222, 2, 111, 222)


def test_integer_mean_of_nothing(spark):
    empty = spark.createDataFrame([], "v bigint")
    assert empty.agg(integer_mean("v")).first()[0] == 0


def test_lookup_rules(spark):
    rules = spark.createDataFrame([("xiaoli", 25), ("xiaofang", 27)], "name string, age int")
    names = spark.createDataFrame([("xiaoli",), ("xiaofang",), ("xiaolin",)], "name string")
    assert as_dict(lookup(names, rules, "name", "age", 0)) == {
        "xiaoli": 25, "xiaofang": 27, "xiaolin": 0}


def test_recode_drops_unknown_class(spark):
    df = spark.createDataFrame([("tested_positive",), ("tested_negative",), ("?",)], "c string")
    label = recode("c", {"tested_positive": 1.0, "tested_negative": 0.0})
    assert [r[0] for r in df.select(label.alias("label")).na.drop().collect()] == [1.0, 0.0]


def test_heights(spark):
    rows = [("Jack", 28, 184), ("Tom", 10, 144), ("Andy", 16, 165)]
    df = spark.createDataFrame(rows, "name string, age int, height int")
    got = df.selectExpr("age + 1 AS next", "name").filter("age > 10").collect()
    assert sorted(tuple(r) for r in got) == [(17, "Andy"), (29, "Jack")]


def test_iso_text(spark):
    df = spark.createDataFrame([("2018-09-13T02:15:16+08:00",), ("-1",)], "s string")
    got = [r[0] for r in df.select(dates.iso_text_to_timestamp("s")).collect()]
    assert got == [datetime.datetime(2018, 9, 13, 2, 15, 16), None]


def test_date_texts(spark):
    row = spark.range(1).select(
        dates.day_before(F.lit(day("2020-01-01"))),
        dates.day_before(F.lit(day("2020-01-01")), dates.DAY_COMPACT),
        dates.week_start(F.lit(day("2019-10-06"))),
        dates.week_start(F.lit(day("2019-10-07"))),
        dates.millis_to_text(F.lit(0).cast("bigint")),
        dates.text_to_millis(F.lit("1970-01-02 00:00:00")),
        dates.text_to_millis(F.lit("never")),
    ).first()
    assert tuple(row) == ("2019-12-31", "20191231", day("2019-09-30"), day("2019-10-07"),
                          "1970-01-01 00:00:00", 86_400_000, None)
    now = spark.range(1).select(dates.today(), dates.day_before(), F.date_format(
        F.current_date(), dates.DAY_COMPACT), F.date_format(F.date_sub(F.current_date(), 1),
                                                           dates.DAY_DASHED)).first()
    assert now[0] == now[2] and now[1] == now[3]


def test_json_map_of_bad_text(spark):
    df = spark.createDataFrame([('{"a":"1"}',), ("{broken",), (None,)], "s string")
    assert [r[0] for r in df.select(jsons.json_map("s")).collect()] == [{"a": "1"}, {}, {}]
