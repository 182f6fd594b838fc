"""Streaming jobs, run over the tables until their input is used up."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemill.functions.text import words
from tidemill.plans import analyses
from tidemill.plans.bounds import checked_broadcast
from tidemill.plans.skew import SALT
from tidemill.queries.aggregates import WORD_COUNT_SQL
from tidemill.queries.projections import points_table
from tidemill.registry import query
from tidemill.session import materialize, work_path
from tidemill.sinks.files import write_json
from tidemill.sinks.keyed import write_batch
from tidemill.sinks.streams import FileWriterPerTask
from tidemill.sources import streams
from tidemill.sinks.versions import Store
from tidemill.streaming import delivery, offsets, runner, state, timed as timers
from tidemill.tables import SCHEMAS

WHOLE_SPAN = "40 days"
PLANNED = "lost on purpose after the results were written"


def timed(t, name="events", column="ts", delay=WHOLE_SPAN):
    """The table as a stream of several micro-batches, a range of times in each file."""
    rows = t.stream_of(name, t.split(name, column), files_per_trigger=1)
    return streams.event_time(rows, column, delay)


ALL_FILES = 1_000_000  # every file of an arrival in one batch


def settled(t, build, label, after_each=None):
    """``build(events)`` over four arrivals of the events, a run of one checkpoint after each."""
    folder, out, checkpoint = (work_path(t.spark, f"{label}-{x}") for x in ("in", "out", "checkpoint"))
    for run in t.arrivals("events", "ts", folder):
        done = build(t.stream_of("events", folder, files_per_trigger=ALL_FILES))
        runner.run_to_files(done, out, checkpoint)
        if after_each:
            after_each(run, checkpoint)
    return t.spark.read.schema(done.schema).parquet(out)


def in_parts(t, name, column):
    """The table as a stream of several micro-batches, for results that no watermark settles."""
    return t.stream_of(name, t.split(name, column), files_per_trigger=1)


@query(
    "stream_project",
    """select event_id, upper(event_type) as kind, value * 2 as doubled from events
       where value > 50
       union all select event_id, 'SMALL', value from events where value < 1""",
)
def stream_project(t):
    events = in_parts(t, "events", "ts")
    large = events.filter(F.col("value") > 50).select(
        "event_id", F.upper("event_type").alias("kind"), (F.col("value") * 2).alias("doubled")
    )
    small = in_parts(t, "events", "event_id").filter(F.col("value") < 1).select(
        "event_id", F.lit("SMALL").alias("kind"), F.col("value").alias("doubled")
    )
    return runner.appended(large.union(small), "project")


@query("stream_files", "select * from events")
def stream_files(t):
    """JSON files with a declared schema, several micro-batches."""
    folder = work_path(t.spark, "json-in")
    for half in (F.col("value") < 50, F.col("value") >= 50):
        write_json(t.events.filter(half), folder, "append")
    read = streams.file_stream(t.spark, "json", folder, SCHEMAS["events"], files_per_trigger=1)
    return runner.appended(read, "files")


@query(
    "stream_queue",
    "select event_type, count(*) as cnt from events group by 1",
)
def stream_queue(t):
    """Batches pushed to a queue folder, taken one at a time."""
    folder = work_path(t.spark, "queue")
    for half in (F.col("value") < 50, F.col("value") >= 50):
        streams.push(t.events.filter(half), folder)
    taken = streams.queue_stream(t.spark, folder, SCHEMAS["events"], one_at_a_time=True)
    return runner.updated(state.running_count(taken, "event_type"), ["event_type"], "queue-out")


@query("stream_custom_source", "select p_name as value from part")
def stream_custom_source(t):
    """Lines through a custom source that tasks can read again: two pushes, one checkpoint,
    the names of the second sorting before those of the first, more files than a batch takes."""
    spark = t.spark
    folder, log = work_path(spark, "lines"), work_path(spark, "lines-log")
    out, checkpoint = work_path(spark, "lines-out"), work_path(spark, "lines-checkpoint")
    lines = t.part.select(F.col("p_name").alias("value"), F.col("p_partkey") % 2 == 0)
    for even in (True, False):
        pushed = work_path(spark, "push")
        few = lines.where(lines[1] == even).select("value").repartition(3)
        few.write.text(pushed)
        streams.move_in(spark, pushed, folder, "b" if even else "a")
        read = streams.line_stream(spark, folder, log, files_per_batch=2)
        streams.run_until_read(
            spark, folder, log, lambda: runner.run_to_files(read, out, checkpoint)
        )
    return spark.read.schema("value string").parquet(out)


@query("stream_file_sink", "select event_id, value, event_type from events")
def stream_file_sink(t):
    """CSV files by event type, exactly once through the sink's own log."""
    path = work_path(t.spark, "csv-out")
    events = in_parts(t, "events", "ts").select("event_id", "value", "event_type")
    checkpoint = work_path(t.spark, "csv-checkpoint")
    runner.run_to_files(events, path, checkpoint, "csv", ["event_type"])
    return t.spark.read.schema(events.schema).csv(path)


@query("stream_memory", "select event_type, count(*) as cnt from events group by 1")
def stream_memory(t):
    """Memory sink polled by SQL; one row per event type."""
    name = f"counts_{uuid.uuid4().hex[:12]}"
    runner.run_to_memory(state.running_count(in_parts(t, "events", "ts"), "event_type"), name)
    return t.spark.sql(f"SELECT event_type, cnt FROM {name}")


@query("stream_foreach", "select s_suppkey, s_name from supplier")
def stream_foreach(t):
    """Row-wise writer with open, process and close."""
    folder = work_path(t.spark, "foreach")
    rows = in_parts(t, "supplier", "s_suppkey").select("s_suppkey", "s_name")
    with runner.stream_conf(t.spark):
        writer = rows.writeStream.foreach(FileWriterPerTask(t.spark, folder))
        writer = writer.option("checkpointLocation", work_path(t.spark, "foreach-checkpoint"))
        runner.finish(writer.trigger(availableNow=True).start())
    return t.spark.read.schema(rows.schema).json(folder)


@query(
    "stream_blacklist",
    """select doc_id, source from documents d where not exists
       (select 1 from labels l where l.doc_id = d.doc_id and l.toxic = 1)""",
)
def stream_blacklist(t):
    """Stream rows whose key is not banned by a static table."""
    banned = t.labels.filter(F.col("toxic") == 1).select("doc_id").distinct()
    documents = in_parts(t, "documents", "doc_id").select("doc_id", "source")
    kept = documents.join(checked_broadcast(banned), "doc_id", "left_anti")
    return runner.appended(kept, "blacklist")


def joined_arrivals(t, build, label):
    """``build(orders, lines)`` over four arrivals of both tables, a run of one checkpoint after
    each, so that what waits for its match is kept from run to run."""
    one, two, out, checkpoint = (
        work_path(t.spark, f"{label}-{x}") for x in ("orders", "lines", "out", "checkpoint")
    )
    arrivals = zip(t.arrivals("orders", "o_orderdate", one), t.arrivals("lineitem", "l_shipdate", two))
    for _ in arrivals:
        orders = t.stream_of("orders", one, files_per_trigger=ALL_FILES)
        lines = t.stream_of("lineitem", two, files_per_trigger=ALL_FILES)
        done = build(
            streams.event_time(orders, "o_orderdate", "30 days").select(
                F.col("o_orderkey").alias("key"), "o_orderdate", "o_totalprice"
            ),
            streams.event_time(lines, "l_shipdate", "30 days").select(
                F.col("l_orderkey").alias("key"), "l_shipdate", "l_linenumber", "l_quantity"
            ),
        )
        runner.run_to_files(done, out, checkpoint)
    return t.spark.read.schema(done.schema).parquet(out)


@query(
    "stream_stream_join",
    """select o_orderkey as key, o_totalprice, l_linenumber, l_quantity, l_shipdate
       from orders join lineitem on o_orderkey = l_orderkey
       where l_shipdate >= o_orderdate and l_shipdate <= o_orderdate + interval 90 days""",
)
def stream_stream_join(t):
    """Order lines shipped within 90 days, both sides streams of several micro-batches."""
    shipped = F.col("l_shipdate").cast("timestamp_ntz").alias("l_shipdate")
    columns = ["key", "o_totalprice", "l_linenumber", "l_quantity", shipped]
    buckets = state.key_buckets(t.spark)
    build = lambda a, b: state.interval_join(a, b, "key", "o_orderdate", "l_shipdate", 90, buckets)
    return joined_arrivals(t, lambda a, b: build(a, b).select(*columns), "joined")


@query(
    "stream_left_outer",
    """with w as (select least((select max(o_orderdate) from orders),
         (select max(l_shipdate) from lineitem)) - interval 30 days as mark),
       p as (select o_orderkey, o_orderdate, l_shipdate, l_linenumber from orders
         left join lineitem on o_orderkey = l_orderkey and l_shipdate >= o_orderdate
         and l_shipdate <= o_orderdate + interval 90 days)
       select o_orderkey as key, o_orderdate, l_shipdate, l_linenumber from p, w
       where l_linenumber is not null or o_orderdate + interval 90 days < mark""",
)
def stream_left_outer(t):
    """Orders with their lines of 90 days; orders without a line when their time is over."""
    stamps = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("o_orderdate", "l_shipdate")]

    buckets = state.key_buckets(t.spark)

    def build(orders, lines):
        joined = state.outer_interval_join(
            orders.drop("o_totalprice"), lines.drop("l_quantity"), "key", "o_orderdate", "l_shipdate", 90, buckets
        )
        return joined.select("key", *stamps, "l_linenumber")

    return joined_arrivals(t, build, "outer")


@query("stream_batch_count", "select event_type, count(*) as cnt from events group by 1")
def stream_batch_count(t):
    """Counts of each micro-batch on its own, then added up."""
    per_batch = work_path(t.spark, "per-batch")

    def handle(frame, batch_id):
        write_batch(state.running_count(frame, "event_type"), batch_id, per_batch)

    read = t.stream_of("events", t.split("events", "ts"), files_per_trigger=1)
    runner.run_each_batch(read, handle, work_path(t.spark, "per-batch-checkpoint"))
    counts = t.spark.read.schema("event_type string, cnt bigint, batch_id bigint")
    return counts.parquet(per_batch).groupBy("event_type").agg(F.sum("cnt").alias("cnt"))


@query(
    "stream_topn",
    "select user_id, count(*) as cnt from events group by 1 order by cnt desc, user_id limit 10",
)
def stream_topn(t):
    """Sorted result table of a complete-mode count."""
    counts = state.running_count(in_parts(t, "events", "ts"), "user_id")
    ranked = counts.orderBy(F.col("cnt").desc(), "user_id").limit(10)
    return runner.completed(ranked, "topn")


@query("stream_running_count", WORD_COUNT_SQL)
def stream_running_count(t):
    """Word count over a folder of text files, two pushes; the words that changed after every
    batch, and the last count of each."""
    folder = work_path(t.spark, "text-in")
    texts = t.documents.select(F.col("text").alias("value"), F.col("doc_id") % 2)
    for rest in (0, 1):
        texts.where(texts[1] == rest).select("value").write.mode("append").text(folder)
    lines = streams.text_stream(t.spark, folder, files_per_trigger=1)
    counts = state.running_count(words(lines, "value"), "word")
    return runner.updated(counts, ["word"], "words")


@query("stream_map_with_state", WORD_COUNT_SQL)
def stream_map_with_state(t):
    """Changed words only after every batch; the last state of each."""
    counts = state.running_count(words(in_parts(t, "documents", "doc_id"), "text"), "word")
    return runner.updated(counts, ["word"], "word-updates")


@query(
    "stream_custom_state",
    """select user_id, count(*) as cnt, cast(sum(cast(trunc(value) as bigint)) as bigint) as total
       from events group by 1""",
)
def stream_custom_state(t):
    """State kept by a function over batches of rows."""
    events = t.stream_of("events", t.split("events", "ts"), files_per_trigger=1)
    amounts = events.select("user_id", F.col("value").cast("bigint").alias("amount"))
    totals = state.running_totals(amounts, "user_id", "amount")
    return state.merged_totals(runner.updated(totals, ["user_id", SALT], "totals"), "user_id")


@query(
    "stream_tumbling",
    """select time_bucket(interval '1 hour', ts) as start, count(*) as cnt,
       round(sum(value), 2) as total from events group by 1""",
)
def stream_tumbling(t):
    measures = [F.count(F.lit(1)).alias("cnt"), F.round(F.sum("value"), 2).alias("total")]
    windows = state.windowed(timed(t), "ts", "1 hour", None, measures)
    return runner.updated(windows, ["start"], "tumbling")


SLIDING_SQL = """(select time_bucket(interval '30 minutes', ts) as start, * from events
    union all select time_bucket(interval '30 minutes', ts) - interval '30 minutes' as start, *
    from events)"""


@query(
    "stream_sliding",
    f"""select start, count(*) as cnt, max(value) as highest from {SLIDING_SQL} group by 1""",
)
def stream_sliding(t):
    measures = [F.count(F.lit(1)).alias("cnt"), F.max("value").alias("highest")]
    windows = state.windowed(timed(t), "ts", "1 hour", "30 minutes", measures)
    return runner.updated(windows, ["start"], "sliding")


@query(
    "stream_window_sum",
    """with s as (select time_bucket(interval '5 seconds', ts) as slot,
         cast(trunc(value) as bigint) as v from events)
       select start, cast(sum(v) as bigint) as total, count(*) as cnt from
         (select slot as start, v from s union all select slot - interval '5 seconds', v from s)
       group by 1""",
)
def stream_window_sum(t):
    measures = [F.sum(F.col("value").cast("bigint")).alias("total"), F.count(F.lit(1)).alias("cnt")]
    windows = state.windowed(timed(t), "ts", "10 seconds", "5 seconds", measures)
    return runner.updated(windows, ["start"], "window-sum")


@query(
    "stream_key_window",
    f"select start, event_type, count(*) as cnt from {SLIDING_SQL} group by 1, 2",
)
def stream_key_window(t):
    measures = [F.count(F.lit(1)).alias("cnt")]
    windows = state.windowed(timed(t), "ts", "1 hour", "30 minutes", measures, ["event_type"])
    return runner.updated(windows, ["start", "event_type"], "key-window")


@query(
    "stream_watermark",
    """select time_bucket(interval '1 day', ts) as start, count(*) as cnt from events group by 1
       having start + interval '1 day' <=
         (select date_trunc('milliseconds', max(ts)) - interval '1 hour' from events)""",
)
def stream_watermark(t):
    """Append mode: a window comes out once the watermark has passed its end."""
    measures = [F.count(F.lit(1)).alias("cnt")]

    def build(events):
        return state.windowed(streams.event_time(events, "ts", "1 hour"), "ts", "1 day", None, measures)

    return settled(t, build, "watermark")


@query("stream_dedup", "select event_id, ts, event_type from events")
def stream_dedup(t):
    """The stream united with itself; one row is kept of each (id, event time)."""
    once, again = timed(t), streams.event_time(t.stream("events"), "ts", WHOLE_SPAN)
    both = once.union(again).select("event_id", "ts", "event_type")
    unique = state.unique(both, ["event_id", "ts"])
    stamp = F.col("ts").cast("timestamp_ntz").alias("ts")
    return runner.appended(unique.select("event_id", stamp, "event_type"), "dedup")


@query("stream_dedup_within", "select event_id, event_type from events")
def stream_dedup_within(t):
    once, again = timed(t), streams.event_time(t.stream("events"), "ts", WHOLE_SPAN)
    both = once.union(again).select("event_id", "ts", "event_type")
    unique = state.unique(both, ["event_id"], "ts")
    return runner.appended(unique.select("event_id", "event_type"), "dedup-within")


@query("stream_restart", "select event_type, count(*) as cnt from events group by 1")
def stream_restart(t):
    """Two runs on one checkpoint: the second reads only the files that came after the
    first, and goes on from its state."""
    folder, checkpoint = work_path(t.spark, "events-in"), work_path(t.spark, "restart")
    out = work_path(t.spark, "restart-out")

    def run():
        read = streams.queue_stream(t.spark, folder, SCHEMAS["events"])

        def handle(frame, batch_id):
            write_batch(frame, batch_id, out)

        counts = state.running_count(read, "event_type")
        runner.run_each_batch(counts, handle, checkpoint, "update")

    for half in (F.col("value") < 50, F.col("value") >= 50):
        streams.push(t.events.filter(half), folder)
        run()
    updates = t.spark.read.schema("event_type string, cnt bigint, batch_id bigint").parquet(out)
    return runner.last_update(updates, ["event_type"])


@query("exactly_once", "select event_id, value from events")
def exactly_once(t):
    """A delivery that fails after two batches of one file, and goes on with three files a
    batch on the same checkpoint. A new checkpoint over the same results is refused."""
    results, log = work_path(t.spark, "results"), work_path(t.spark, "offsets")
    checkpoint = work_path(t.spark, "once-checkpoint")
    folder = t.split("events", "ts")

    def run(per_trigger, positions, where):
        rows = t.stream_of("events", folder, files_per_trigger=per_trigger)
        rows = rows.select("event_id", "value", "event_type", "ts")
        delivery.deliver_once(rows, results, log, where, positions)

    def fails_later(frame):
        if t.spark.read.parquet(results).select("batch_id").distinct().count() > 2:
            raise RuntimeError(PLANNED)
        return event_positions(frame)

    for positions, where in (
        (fails_later, checkpoint),
        (event_positions, checkpoint),
        (event_positions, work_path(t.spark, "other-checkpoint")),
    ):
        try:
            run(1 if positions is fails_later else 3, positions, where)
        except (StreamingQueryException, ValueError) as error:
            if PLANNED not in str(error) and "another checkpoint" not in str(error):
                raise
    return t.spark.read.parquet(results).select("event_id", "value")


def event_positions(frame):
    """The event id as the offset, the event type as the topic."""
    return frame.groupBy(F.col("event_type").alias("topic")).agg(
        F.lit("group").alias("grp"),
        F.lit(0).alias("part"),
        F.max("event_id").alias("offset"),
        F.max("ts").alias("ts"),
    )


@query(
    "stream_offsets",
    """select 'group' as grp, event_type as topic, 0 as part, max(event_id) as "offset"
       from events group by 2""",
)
def stream_offsets(t):
    """Offsets that were stored with the results."""
    results, log = work_path(t.spark, "results"), work_path(t.spark, "offsets")
    rows = t.stream("events").select("event_id", "value", "event_type", "ts")
    delivery.deliver_once(
        rows, results, log, work_path(t.spark, "offsets-checkpoint"), event_positions
    )
    return t.spark.read.parquet(log).select("grp", "topic", "part", "offset")


@query(
    "stream_dynamic_rules",
    """select event_id, cast(case event_type when 'view' then 1 when 'click' then 2 when 'signup'
       then 2 when 'purchase' then 5 else 0 end * case when ts < timestamp '2024-01-16' then 1
       else 10 end as integer) as points from events""",
)
def stream_dynamic_rules(t):
    """Rules that change between two batches; each batch uses those of its time."""
    folder, rules = work_path(t.spark, "events-in"), work_path(t.spark, "rules")
    out, checkpoint = work_path(t.spark, "scored"), work_path(t.spark, "rules-checkpoint")
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for half, factor in ((first, 1), (~first, 10)):
        current = points_table(t).withColumn("points", F.col("points") * factor)
        current.coalesce(1).write.mode("overwrite").parquet(rules)
        streams.push(t.events.filter(half), folder)
        read = streams.queue_stream(t.spark, folder, SCHEMAS["events"])
        delivery.score_with_current_rules(
            read.select("event_id", "event_type"), rules, "event_type", "points", out, checkpoint
        )
    return t.spark.read.parquet(out).select("event_id", "points")


@query(
    "stream_dashboard",
    """with s as (select time_bucket(interval '5 seconds', ts) as slot,
         sum(cast(trunc(value) as bigint)) as s, count(*) as n from events group by 1)
       select 'sumMoney5' as event, slot, cast(s as bigint) as value from s
       union all select 'avgMoney5', slot, cast(s // n as bigint) from s
       union all select 'sumMoneyWin10', start, cast(sum(s) as bigint) from
         (select slot as start, s from s union all
          select slot - interval '5 seconds', s from s) group by start""",
)
def stream_dashboard(t):
    """Sum and mean per 5 seconds, sum per 10 seconds every 5, all in one metric table. The
    stream is read once: it keeps the 5-second slots, and the longer windows come from them."""
    measures = [F.sum(F.col("value").cast("bigint")).alias("s"), F.count(F.lit(1)).alias("n")]
    slots = runner.updated(
        state.windowed(timed(t), "ts", "5 seconds", None, measures), ["start"], "slots"
    )
    metrics = analyses.slot_metrics(materialize(slots.withColumnRenamed("start", "slot"), "slots"))
    return metrics.select("event", "slot", "value")


# the time in microseconds, and the number of the arrival
ARRIVED_SQL = """(select epoch_us(ts) as us, cast(trunc(value) as bigint) as amount,
    (epoch_us(ts) - min(epoch_us(ts)) over ())
      // ((max(epoch_us(ts)) over () - min(epoch_us(ts)) over ()) // 4 + 1) as arrival,
    user_id, event_type from events)"""


@query(
    "stream_sessions",
    f"""with runs as (select r, e.* from {ARRIVED_SQL} e, range(0, 4) runs(r) where arrival <= r),
        marks as (select r, max(us) // 1000 - 7200000 as mark from runs group by r),
        cuts as (select *, us - lag(us) over (partition by r, user_id order by us) > 21600000000
          as gap from runs),
        parts as (select *, sum(coalesce(gap, true)::int) over (partition by r, user_id
          order by us rows unbounded preceding) as part from cuts),
        sessions as (select r, user_id, min(us) as a, max(us) as b, count(*) as cnt,
          cast(sum(amount) as bigint) as total from parts group by r, user_id, part),
        told as (select *, (b + 21600000000 + 999) // 1000 > mark as open
          from sessions join marks using (r))
        select cast(case when open then r else -1 end as integer) as run, user_id as key,
          make_timestamp(a) as start, make_timestamp(b) as stop, cnt, total
        from told where open or r = 3""",
)
def stream_sessions(t):
    """Sessions that end after six hours without an event, by timers over four arrivals; run -1
    has the closed ones, run n the open ones as the state store holds them after arrival n."""
    kept = []

    def look(run, checkpoint):
        found = timers.snapshot(t.spark, checkpoint, "open")
        kept.append(materialize(found.withColumn("run", F.lit(run)), "open"))

    gap, delay, buckets = 6 * 3600, "2 hours", state.key_buckets(t.spark)
    closed = settled(
        t,
        lambda e: timers.sessions(e, "user_id", "ts", F.col("value"), gap, delay, buckets),
        "sessions",
        look,
    ).withColumn("run", F.lit(-1))
    columns = ["run", "key", "start", "stop", "cnt", "total"]
    rows = closed.select(*columns)
    for found in kept:
        times = {c: timers.zoneless(c) for c in ("start", "stop")}
        rows = rows.union(found.withColumns(times).select(*columns))
    return rows


def panes_sql(key: str, width: int, slide: int) -> str:
    return f"""with panes as (select {key} as key, us // {slide}000000 as slot, count(*) as cnt,
          sum(amount) as total, max(amount) as highest from {ARRIVED_SQL} group by all),
        mark as (select max(slot) * {slide} - 7200 as mark from panes),
        spread as (select *, slot - unnest(range(0, {width // slide})) as first from panes)
        select key, make_timestamp(first * {slide}000000) as start, cast(sum(cnt) as bigint) as cnt,
          cast(sum(total) as bigint) as total, max(highest) as highest
        from spread group by key, first
        having first * {slide} + {width} <= (select mark from mark)"""


@query("stream_pane_windows", panes_sql("''", 3600, 5))
def stream_pane_windows(t):
    """An hour every five seconds: each row is counted in one pane, not in 720 windows."""
    build = lambda e: timers.paned_windows(e, "ts", F.col("value"), 3600, 5, "2 hours")
    return settled(t, build, "panes")


@query("stream_pane_key_windows", panes_sql("event_type", 3600, 600))
def stream_pane_key_windows(t):
    """An hour every ten minutes per kind of event."""
    build = lambda e: timers.paned_windows(
        e, "ts", F.col("value"), 3600, 600, "2 hours", "event_type"
    )
    return settled(t, build, "key-panes")


@query("stream_from_offsets", "select p_name as value, 'lines' as topic from part")
def stream_from_offsets(t):
    """A second checkpoint goes on where the offsets table says: what the first one delivered is
    not read again, what came since is. Lines and offsets are published together."""
    spark = t.spark
    folder, log = work_path(spark, "lines"), work_path(spark, "lines-log")
    store = Store(spark, work_path(spark, "delivered"))
    lines = t.part.select(F.col("p_name").alias("value"), F.col("p_partkey") % 3)
    for third in range(3):
        pushed = work_path(spark, "push")
        lines.where(lines[1] == third).select("value").write.text(pushed)
        streams.move_in(spark, pushed, folder, f"{9 - third}")
        tables = store.version().tables
        start = None
        if "offsets" in tables:
            start = offsets.latest_offsets(store.read("offsets")).first()["offset"]
        read = streams.line_stream(spark, folder, log, start=start, with_entry=True)
        # the last checkpoint is used twice, the one before was lost
        owner = f"run-{min(third, 1)}"
        checkpoint = f"{log}-{owner}"
        delivery.deliver_versions(read, store, owner, checkpoint, reached)
    return store.read("results").select("value", F.lit("lines").alias("topic"))


def reached(frame):
    now = F.current_timestamp().cast("timestamp_ntz").alias("ts")
    named = [F.lit("g").alias("grp"), F.lit("lines").alias("topic"), F.lit(0).alias("part")]
    last = frame.agg(F.max("entry").alias("offset")).where("offset is not null")
    return last.select(*named, "offset", now)
