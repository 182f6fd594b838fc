"""The worked analyses on the event tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.plans import analyses, points
from tidemill.queries.projections import POINTS_SQL, points_table
from tidemill.queries.scalars import MONDAY
from tidemill.registry import query
from tidemill.session import materialize

# fixed values: the event types, and a label for each
TYPES = ["click", "error", "purchase", "signup", "view"]
TAG_LABELS = {"click": "A", "error": "B", "purchase": "C", "signup": "D"}


def visits(t):
    return t.events.select("user_id", F.col("ts").cast("date").alias("day"))


@query(
    "longest_streak",
    """with d as (select distinct user_id, cast(ts as date) as day from events),
       r as (select user_id, day - cast(row_number() over (partition by user_id order by day)
         as integer) as run from d),
       n as (select user_id, run, count(*) as c from r group by 1, 2)
       select user_id, max(c) as cnt_days from n group by 1""",
)
def longest_streak(t):
    return analyses.longest_streaks(visits(t), "user_id", "day")


PIVOT_COLUMNS = ", ".join(
    f"round(coalesce(sum(value) filter (where event_type = '{v}'), 0), 2) as {v}" for v in TYPES
)


def rounded(df):
    numbers = [c for c in df.columns if c != "user_id"]
    return df.select("user_id", *[F.round(c, 2).alias(c) for c in numbers])


@query("pivot_sum", f"select user_id, {PIVOT_COLUMNS} from events group by 1")
def pivot_sum(t):
    return rounded(analyses.pivot_sums(t.events, "user_id", "event_type", TYPES, "value"))


@query("pivot_when", f"select user_id, {PIVOT_COLUMNS} from events group by 1")
def pivot_when(t):
    return rounded(analyses.pivot_when(t.events, "user_id", "event_type", TYPES, "value"))


@query(
    "total_row",
    f"""select cast(user_id as varchar) as user_id, {PIVOT_COLUMNS}, round(sum(value), 2) as total
        from events group by user_id
        union all select 'total', {PIVOT_COLUMNS}, round(sum(value), 2) from events""",
)
def total_row(t):
    return rounded(analyses.pivot_with_total(t.events, "user_id", "event_type", TYPES, "value"))


PART_COLUMNS = ", ".join(
    f"round(coalesce(sum(value) filter (where event_type = '{v}'), 0), 2) as {v}" for v in TYPES[:3]
)


@query(
    "total_row_part",
    f"""select cast(user_id as varchar) as user_id, {PART_COLUMNS}, round(sum(value), 2) as total
        from events group by user_id
        union all select 'total', {PART_COLUMNS}, round(sum(value), 2) from events""",
)
def total_row_part(t):
    """Some types have no column of their own and count in the total all the same."""
    return rounded(
        analyses.pivot_with_total(t.events, "user_id", "event_type", TYPES[:3], "value")
    )


@query(
    "pv_uv",
    """with f as (select user_id, min(cast(ts as date)) as day from events group by 1),
       n as (select day, count(*) as new_uv from f group by 1)
       select e.day, pv, uv, coalesce(new_uv, 0) as new_uv from (select cast(ts as date) as day,
         count(*) as pv, count(distinct user_id) as uv from events group by 1) e
       left join n on e.day = n.day""",
)
def pv_uv(t):
    return analyses.page_and_visitor_counts(visits(t), "user_id", "day")


@query(
    "pv_uv_joined",
    """select cast(ts as date) as day, count(*) as pv, count(distinct user_id) as uv
       from events group by 1""",
)
def pv_uv_joined(t):
    return analyses.counts_joined(visits(t), "user_id", "day")


@query(
    "word_count_by_key",
    r"""select conv_id, word, count(*) as cnt from (select conv_id,
        unnest(regexp_split_to_array(text, '\s+')) as word from conversations)
        where word <> '' group by 1, 2""",
)
def word_count_by_key(t):
    return analyses.words_by_key(t.conversations, "conv_id", "text")


@query(
    "tag_lookup",
    """with tagged as (select distinct tags from (select string_agg(distinct event_type, ','
         order by event_type) as tags from events group by user_id, cast(ts as date))),
       pairs as (select tags, unnest(string_split(tags, ',')) as tag from tagged)
       select tags, string_agg(label, ',' order by label) as labels from pairs join
         (values ('click', 'A'), ('error', 'B'), ('purchase', 'C'), ('signup', 'D'))
         l(tag, label) using (tag) group by tags""",
)
def tag_lookup(t):
    """Tags of a user's day, looked up."""
    day = F.col("ts").cast("date").alias("day")
    tags = t.events.select("user_id", day, "event_type").distinct().groupBy("user_id", "day").agg(
        F.concat_ws(",", F.sort_array(F.collect_set("event_type"))).alias("tags")
    )
    labels = t.spark.createDataFrame(list(TAG_LABELS.items()), "tag string, label string")
    return analyses.label_tags(tags, "tags", labels, "tag", "label")


@query(
    "peaks_troughs",
    """select user_id, ts, value, kind from (select user_id, ts, value,
         case when value > lag(value) over w and value > lead(value) over w then 'peak'
              when value < lag(value) over w and value < lead(value) over w then 'trough' end
         as kind from events window w as (partition by user_id, cast(ts as date)
         order by ts, event_id)) where kind is not null""",
)
def peaks_troughs(t):
    ticks = t.events.select(
        "event_id", "user_id", "ts", "value", F.col("ts").cast("date").alias("day")
    )
    found = analyses.peaks_and_troughs(ticks, ["user_id", "day"], ["ts", "event_id"], "value")
    return found.select("user_id", "ts", "value", "kind")


@query(
    "user_level",
    f"""with s as (select e.user_id, sum(coalesce(r.points, 0)) as score from events e
          left join {POINTS_SQL} on e.event_type = r.event_type
          where ts >= timestamp '2024-01-08' and ts < timestamp '2024-01-15' group by 1),
        u as (select distinct user_id from events)
        select user_id, cast(coalesce(score, 0) as bigint) as uscore,
          {points.LEVELS_SQL.format("coalesce(score, 0)")} as ulevel
        from u left join s using (user_id)""",
)
def user_level(t):
    return points.weekly_levels(
        t.events,
        points_table(t),
        "user_id",
        "event_type",
        "ts",
        F.lit(MONDAY),
    )


@query(
    "dashboard_batch",
    """with s as (select time_bucket(interval '5 seconds', ts) as slot,
         sum(cast(trunc(value) as bigint)) as s, count(*) as n from events group by 1)
       select 'sumMoney5' as event, slot, cast(s as bigint) as value from s
       union all select 'avgMoney5', slot, cast(s // n as bigint) from s
       union all select 'sumMoneyWin10', start, cast(sum(s) as bigint) from
         (select slot as start, s from s union all
          select slot - interval '5 seconds', s from s) group by start""",
)
def dashboard_batch(t):
    amounts = t.events.select("ts", F.col("value").cast("bigint").alias("amount"))
    return analyses.dashboard_slots(amounts, "ts", "amount")


@query(
    "visitors_by_period",
    """select 'day' as kind, cast(ts as date) as period, count(distinct user_id) as visitors
         from events group by 2
       union all select 'week', cast(date_trunc('week', ts) as date), count(distinct user_id)
         from events group by 2
       union all select 'month', cast(date_trunc('month', ts) as date), count(distinct user_id)
         from events group by 2""",
)
def visitors_by_period(t):
    """Three periods from one stored set per day."""
    sets = materialize(analyses.visitor_sets(visits(t), "user_id", "day"), "visitors")
    out = None
    for kind in ("day", "week", "month"):
        start = F.trunc("day", kind) if kind != "day" else F.col("day")
        counts = analyses.visitors_per(sets, start).select(F.lit(kind).alias("kind"), "period", "visitors")
        out = counts if out is None else out.union(counts)
    return out
