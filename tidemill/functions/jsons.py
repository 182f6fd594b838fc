"""JSON columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_map(column: str | Column) -> Column:
    """JSON object as map<string,string>; an empty map when the text is no object."""
    parsed = F.from_json(column, "map<string,string>")
    return F.coalesce(parsed, F.create_map().cast("map<string,string>"))


def row_json(*columns: str) -> Column:
    return F.to_json(F.struct(*columns))
