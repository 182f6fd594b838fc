"""Size checks that stand in front of every broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
FIXED_WIDTH = 8
# a row of a broadcast: null bits, its place in the hash table, the object around it
ROW_WIDTH = 64


def measured_bytes(df: DataFrame) -> int:
    """Size as rows of a broadcast's hash table, from one aggregate: every column has 8 bytes,
    texts and nested values their length beside, every row ROW_WIDTH."""
    width = F.lit(ROW_WIDTH + FIXED_WIDTH * len(df.schema.fields))
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def checked_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint when ``df`` is measured to fit; otherwise ``df`` as it is,
    so that the join shuffles and AQE splits skewed partitions."""
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]):
    """``left.a <=> right.b and ...`` over column pairs."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition
