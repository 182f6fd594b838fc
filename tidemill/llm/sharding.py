"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``VNODES`` points on a ring of 64-bit hashes; a document belongs to the first
point clockwise of the hash of its doc_id. No shard takes more than its room: what it cannot
take goes on clockwise to the next other shard, and on, until there is room. With no slack the
rooms add up to the number of rows, so row counts differ by one at most. A new shard takes over
some arcs of the ring; the other documents move only where rooms change.

A document's way round the ring depends on its arc alone, so the decision needs the number of
rows per arc only (shards * VNODES counts, whatever the table's size): each arc's rows, in
ring order, are cut into stretches, one per shard. A row finds its stretch by its rank in its
arc. Ranks come from windows over cells, slices of the ring with about ``CELL_ROWS`` rows, and
the running total of the cells before. DataFrame functions only.

Defined results: a null text has no bytes and the crc32 of none; a null doc_id is placed by its
text's crc32; rows with one doc_id have one place on the ring, are ordered by crc32 and size
there, and may be parted where a shard is full; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math

import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.session import materialize

SHARDS = 24
VNODES = 128
CELL_ROWS = 50_000
SLOT_BITS = 12  # the table that finds a row's arc has this many slots (2 ** 12)


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(unsigned place, shard) of every virtual node in clockwise order."""
    return sorted(
        (xxhash.xxh64_intdigest(f"shard {s} point {v}".encode()), s)
        for s in range(shards)
        for v in range(vnodes)
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def arc_table(spark: SparkSession, points: list[tuple[int, int]]) -> DataFrame:
    """Per slot of the ring the virtual nodes in it and the first one after it."""
    width = 64 - SLOT_BITS
    inside: list[list] = [[] for _ in range(1 << SLOT_BITS)]
    for arc, (place, _) in enumerate(points):
        inside[place >> width].append((_signed(place), arc))
    after, rows = 0, []
    for slot in reversed(range(1 << SLOT_BITS)):
        rows.append((slot, inside[slot], after))
        if inside[slot]:
            after = inside[slot][0][1]
    return spark.createDataFrame(
        rows, "slot long, points array<struct<place:long, arc:int>>, after int"
    )


def rooms(total: int, shards: int, slack: float) -> list[int]:
    if slack:
        return [math.ceil((1 + slack) * total / shards)] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def stretches(
    counts: list[int], owners: list[int], room: list[int]
) -> list[list[tuple[int, int, int, int]]]:
    """Per arc its stretches (from rank, to rank, shard, first slot). In each round every arc
    offers what is left to the next shard clockwise that it has not yet asked."""
    size, shards = len(owners), len(room)
    way = []
    for arc in range(size):
        seen: list[int] = []
        at = arc
        while len(seen) < shards and at < arc + size:
            if owners[at % size] not in seen:
                seen.append(owners[at % size])
            at += 1
        way.append(seen)
    used, done = [0] * shards, [0] * size
    out: list[list[tuple[int, int, int, int]]] = [[] for _ in range(size)]
    for turn in range(shards):
        for arc in range(size):
            shard = way[arc][turn]
            take = min(counts[arc] - done[arc], room[shard] - used[shard])
            if take:
                out[arc].append((done[arc], done[arc] + take, shard, used[shard]))
                done[arc] += take
                used[shard] += take
    return out


def assign(
    keys: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: float = 0.0
) -> DataFrame:
    """``keys`` (with ``place long`` and tie-breakers ``text_crc32``, ``size``), written once by
    the caller, with ``home_shard, shard, slot``."""
    spark = keys.sparkSession
    points = ring(shards, vnodes)
    total = keys.count()
    bits = max(0, math.ceil(math.log2(max(1, total / CELL_ROWS))))
    slots = F.broadcast(arc_table(spark, points))  # 2 ** SLOT_BITS rows
    cell = F.shiftrightunsigned("place", 64 - bits) if bits else F.lit(0).cast("long")
    found = F.get(F.filter("points", lambda p: p["place"] >= F.col("place")), F.lit(0))
    placed = (
        keys.withColumn("slot", F.shiftrightunsigned("place", 64 - SLOT_BITS))
        .join(slots, "slot")
        .withColumn("arc", F.coalesce(found["arc"], "after"))
        .withColumn("cell", cell)
        .drop("slot", "points", "after")
    )
    counts = materialize(placed.groupBy("arc", "cell").agg(F.count("*").alias("n")), "cells")
    per_arc = [0] * len(points)
    for row in counts.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # one per arc
        per_arc[row["arc"]] = row["n"]
    owners = [shard for _, shard in points]
    plan = stretches(per_arc, owners, rooms(total, shards, slack))
    parts = spark.createDataFrame(
        [(arc, owners[arc], part) for arc, part in enumerate(plan)],
        "arc int, home_shard int,"
        " parts array<struct<low:long, high:long, shard:int, first:long>>",
    )
    before = F.sum("n").over(Window.partitionBy("arc").orderBy("cell")) - F.col("n")
    starts = counts.select("arc", "cell", before.alias("start"))
    in_cell = Window.partitionBy("arc", "cell").orderBy("place", "doc_id", "text_crc32", "size")
    ranked = (
        placed.withColumn("nth", F.row_number().over(in_cell) - 1)
        .join(starts, ["arc", "cell"])
        .withColumn("rank", F.col("start") + F.col("nth"))
        .join(F.broadcast(parts), "arc")  # shards * vnodes rows, shards parts each at most
    )
    here = F.filter(
        "parts", lambda p: (p["low"] <= F.col("rank")) & (F.col("rank") < p["high"])
    )
    return ranked.withColumn("part", F.get(here, F.lit(0))).select(
        *keys.columns,
        "home_shard",
        F.col("part.shard").alias("shard"),
        (F.col("part.first") + F.col("rank") - F.col("part.low")).alias("slot"),
    )


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard``."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    doc = F.col("doc_id").cast("long")
    keys = docs.select(
        doc.alias("doc_id"),
        (F.length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    ).withColumn("place", F.xxhash64(F.coalesce("doc_id", "text_crc32")))
    return assign(materialize(keys, "keys"), shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard",
    )
