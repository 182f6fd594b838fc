"""Date and time columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: date formats
DATE_TIME = "yyyy-MM-dd HH:mm:ss"
DAY_DASHED = "yyyy-MM-dd"
DAY_COMPACT = "yyyyMMdd"
ISO_TEXT = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2}(?:\.\d{1,9})?)(?:Z|[+-]\d{2}:?\d{2})?$"


def millis_to_text(millis: str | Column, fmt: str = DATE_TIME) -> Column:
    return F.date_format(F.timestamp_millis(millis), fmt)


def text_to_millis(text: str | Column, fmt: str = DATE_TIME) -> Column:
    """Epoch milliseconds in the session zone; NULL for text that does not parse."""
    return F.unix_millis(F.try_to_timestamp(text, F.lit(fmt)))


def epoch_seconds(text: str | Column, fmt: str = DATE_TIME) -> Column:
    return F.unix_seconds(F.try_to_timestamp(text, F.lit(fmt)))


def reformat_date(text: str | Column, source: str, target: str) -> Column:
    return F.date_format(F.try_to_timestamp(text, F.lit(source)), target)


def day_before(day: Column | None = None, fmt: str = DAY_DASHED) -> Column:
    return F.date_format(F.date_sub(F.current_date() if day is None else day, 1), fmt)


def today(fmt: str = DAY_COMPACT) -> Column:
    return F.date_format(F.current_date(), fmt)


def now_millis() -> Column:
    return F.unix_millis(F.current_timestamp())


def now_text(fmt: str = DATE_TIME) -> Column:
    return F.date_format(F.current_timestamp(), fmt)


def iso_text_to_timestamp(text: str | Column) -> Column:
    """``2018-09-13T02:15:16+08:00`` as written, without its zone (``Z``, ``+08:00`` or
    ``-05:00``) and with its fraction; NULL if it is no date-time."""
    day, time = F.regexp_extract(text, ISO_TEXT, 1), F.regexp_extract(text, ISO_TEXT, 2)
    return F.try_to_timestamp(F.concat(day, F.lit(" "), time))


def week_start(day: str | Column) -> Column:
    """Monday of the ISO week that holds ``day``."""
    return F.date_add(F.next_day(day, "MO"), -7)


def in_week(moment: Column, monday: Column) -> Column:
    """``[monday, monday + 7 days)``."""
    day = moment.cast("date")
    return (day >= monday) & (day < F.date_add(monday, 7))


def years_between(later: Column, earlier: Column, scale: int = 0) -> Column:
    return F.round(F.months_between(later, earlier) / 12, scale)
