"""Text columns: words, list cells, access-log lines, delimited keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the start of an access-log line (sizes and codes may be "-") and its time format
LOG_PATTERN = r"^(\S+) \S+ \S+ \[([^\]]+)\] ."
LOG_TIME = "dd/MMM/yyyy:HH:mm:ss"
LOG_TIME_ZONED = "dd/MMM/yyyy:HH:mm:ss Z"


def words(df: DataFrame, text: str, keep: list[str] = (), separator: str = r"\s+") -> DataFrame:
    """One row per non-empty word, with the ``keep`` columns."""
    exploded = df.select(*keep, F.explode(F.split(text, separator)).alias("word"))
    return exploded.filter(F.col("word") != "")


def cell_items(column: str | Column, separator: str = ",") -> Column:
    """A delimited cell as an array of trimmed items."""
    return F.transform(F.split(column, separator), lambda item: F.trim(item))


def quoted_field(column: str | Column, index: int) -> Column:
    """Piece ``index`` (from 0) of the text split on double quotes; NULL if absent."""
    return F.get(F.split(column, '"'), F.lit(index))


def log_ip(line: str | Column) -> Column:
    return F.regexp_extract(line, LOG_PATTERN, 1)


def log_instant(line: str | Column) -> Column:
    """The moment of the request; NULL where the line does not parse."""
    return F.try_to_timestamp(F.regexp_extract(line, LOG_PATTERN, 2), F.lit(LOG_TIME_ZONED))


def log_day(line: str | Column) -> Column:
    """The calendar day as written in the line, in the line's own zone."""
    written = F.regexp_extract(line, LOG_PATTERN, 2)
    stamp = F.regexp_extract(written, r"^(\S+)", 1)
    return F.try_to_timestamp(stamp, F.lit(LOG_TIME)).cast("date")


def joined_key(*parts: str | Column, separator: str = ":") -> Column:
    """Row keys and store keys such as ``topic:group``."""
    return F.concat_ws(separator, *parts)


def tagged(tag: str, column: str | Column) -> Column:
    """``tag@value``."""
    return F.concat_ws("@", F.lit(tag), column)
