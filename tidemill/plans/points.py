"""User points and levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.dates import in_week
from tidemill.operators.columns import levels, lookup

# fixed values: level names and the scores where each range ends
LEVELS = [(1000, "普通"), (3000, "银牌"), (10000, "金牌")]
TOP_LEVEL = "钻石"
LEVELS_SQL = (
    "case when {0} < 1000 then '普通' when {0} < 3000 then '银牌'"
    " when {0} < 10000 then '金牌' else '钻石' end"
)
# fixed values: action code -> points (follow, like, review, buy)
ACTION_POINTS = {"01": 1, "02": 2, "03": 2, "05": 5}
ACTION_TIME = "yyyyMMddHHmmss"


def level_of(score: str | Column) -> Column:
    return levels(score, LEVELS, TOP_LEVEL)


def action_time(text: str | Column) -> Column:
    """NULL for a text that is no time of day, such as hour 26."""
    return F.try_to_timestamp(text, F.lit(ACTION_TIME))


def weekly_levels(
    actions: DataFrame,
    points: DataFrame,
    user: str,
    action: str,
    moment: str,
    monday: Column,
    users: DataFrame | None = None,
) -> DataFrame:
    """Points per user in ``[monday, monday + 7)`` and the level; users without an action
    in the week have 0 points.

    Without a list of ``users`` all users that ever acted are meant, and one pass over the
    actions gives both them and their points. With a list only the week is read.
    """
    this_week = in_week(F.col(moment), monday)
    if users is not None:
        actions = actions.filter(this_week)
    scored = lookup(actions.select(user, action, moment), points, action, "points", 0)
    sums = scored.groupBy(user).agg(F.sum(F.when(this_week, F.col("points"))).alias("uscore"))
    if users is not None:
        sums = users.join(sums, user, "left")
    score = F.coalesce(F.col("uscore"), F.lit(0).cast("bigint"))
    return sums.select(user, score.alias("uscore")).withColumn("ulevel", level_of("uscore"))
