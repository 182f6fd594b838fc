"""The ordered operators on their path for large keys: every event type has more rows than one
task may take here, whatever the size of the table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators.ordering import zip_with_index
from tidemill.plans import analyses
from tidemill.plans.ordered import LargeKeys, OrderedKeys
from tidemill.registry import query

TASKS = 12  # a task takes a twelfth of the rows, a key has about a fifth


def events(t):
    """The events with their day, and the rows that one task may take."""
    rows = t.events.withColumn("day", F.col("ts").cast("date"))
    return rows, max(1, rows.count() // TASKS)


@query(
    "blocks_rank",
    """select event_id, rank() over (partition by event_type order by cast(ts as date)) as rnk,
       dense_rank() over (partition by event_type order by cast(ts as date)) as dense,
       row_number() over (partition by event_type order by ts, event_id) as rn from events""",
)
def blocks_rank(t):
    rows, limit = events(t)
    rows = rows.select("event_id", "event_type", "day", "ts")
    large = LargeKeys.measure(rows, ["event_type"], limit)
    numbered = OrderedKeys(rows, ["event_type"], ["ts", "event_id"], limit, large).position("rn")
    ranked = OrderedKeys(numbered, ["event_type"], ["day"], limit, large).ranks("rnk", "dense")
    return ranked.select("event_id", "rnk", "dense", "rn")


@query(
    "blocks_running",
    """select event_id, count(*) over (partition by event_type order by cast(ts as date)) as upto,
       count(*) over (partition by event_type order by ts, event_id rows between unbounded
       preceding and current row) as nth from events""",
)
def blocks_running(t):
    rows, limit = events(t)
    rows = rows.select("event_id", "event_type", "day", "ts")
    upto = OrderedKeys(rows, ["event_type"], ["day"], limit).running_range(
        "upto", "count", F.lit(1)
    )
    both = OrderedKeys(upto, ["event_type"], ["ts", "event_id"], limit).running(
        "nth", "count", F.lit(1)
    )
    return both.select("event_id", "upto", "nth")


@query(
    "blocks_index",
    "select event_id, row_number() over (order by ts, event_id) - 1 as index from events",
)
def blocks_index(t):
    rows, limit = events(t)
    numbered = zip_with_index(rows.select("event_id", "ts"), ["ts", "event_id"], rows_per_task=limit)
    return numbered.drop("ts")


@query(
    "blocks_peaks",
    """select event_type, event_id, kind from (select event_type, event_id,
         case when value > lag(value) over w and value > lead(value) over w then 'peak'
              when value < lag(value) over w and value < lead(value) over w then 'trough' end
         as kind from events window w as (partition by event_type order by ts, event_id))
       where kind is not null""",
)
def blocks_peaks(t):
    rows, limit = events(t)
    found = analyses.peaks_and_troughs(
        rows, ["event_type"], ["ts", "event_id"], "value", limit
    )
    return found.select("event_type", "event_id", "kind")
