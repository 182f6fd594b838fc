"""Near duplicates by SimHash: pigeonhole blocks, a join on blocks, then the Hamming distance.

A fingerprint is cut into ``distance + 3`` blocks. Two fingerprints that differ in at most
``distance`` bits agree on at least three of them, so every choice of three blocks is a join
key of about 38 bits (distance 2). Only distinct fingerprints are joined. A block that many
fingerprints share is not expanded into pairs: there each fingerprint is listed under all
values within half the distance, and those that meet under a value hang on the nearest of
them. Two fingerprints meet so exactly when they are close enough, and at most as many as
there are such values can meet.

Defined results: null text is empty, a text without words has fingerprint 0, which links like
any other; fewer words than a shingle make one shingle; a null doc_id is the smallest of its
component only if there is no other, then component_id is null; repeated rows keep their row
each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import components, keep_rows, raw_text
from tidemill.session import materialize

SHINGLE = 3
DISTANCE = 2
SEED = 42
SHARED = 3  # blocks two close fingerprints agree on at least
PAIRS_UP_TO = 32  # members of a block that are compared pair by pair
SLICE = 1 << 16  # hashes whose bits are counted at once

PRINT = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("fp", pa.int64())])


def fingerprint(raw: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned 64-bit fingerprint of a text in UTF-8."""
    words = raw.lower().split()  # bytes: only A-Z, only the six ASCII blanks
    if not words:
        return 0
    text = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(text, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    cuts = map(slice, starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    count = len(words) - shingle + 1
    hashes = np.fromiter(
        map(xxhash.xxh64_intdigest, map(text.__getitem__, cuts), repeat(SEED)),
        dtype=np.uint64,
        count=count,
    )
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, count, SLICE):
        part = hashes[at : at + SLICE].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int32)
    bits = np.packbits(votes * 2 > count)
    return int.from_bytes(bits.tobytes(), "big")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _prints(shingle: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [_signed(fingerprint(raw, shingle)) for raw in batch["raw"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["tag"], pa.array(prints, pa.int64())], schema=PRINT
            )

    return task


def masks(distance: int) -> list[int]:
    """For every choice of SHARED blocks the signed mask of their bits."""
    count = distance + SHARED
    edge = [64 * i // count for i in range(count + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    return [_signed(sum(c)) for c in combinations(block, SHARED)]


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Edges ``a, b`` between the distinct fingerprints of ``prints(fp)`` that connect
    exactly those that differ in at most ``distance`` bits."""
    table = F.array(*[F.lit(m) for m in masks(distance)])
    keys = prints.select("fp", F.posexplode(table).alias("which", "mask")).select(
        "which", F.col("fp").bitwiseAND(F.col("mask")).alias("block"), "fp"
    )
    sizes = keys.groupBy("which", "block").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(keys.join(sizes, ["which", "block"]), "blocks")
    few = members.where(F.col("n") <= PAIRS_UP_TO)
    pairs = (
        few.select("which", "block", F.col("fp").alias("a"))
        .join(few.select("which", "block", F.col("fp").alias("b")), ["which", "block"])
        .where("a < b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .select("a", "b")
    )
    crowd = members.where(F.col("n") > PAIRS_UP_TO).select("fp").distinct()
    return pairs.union(_meetings(crowd, distance)).distinct()


def _meetings(crowd: DataFrame, distance: int) -> DataFrame:
    """Links among ``crowd(fp)`` without pairs: under each value near a fingerprint, all that
    are near it hang on the nearest one if their distances to the value allow it."""
    reach = (distance + 1) // 2
    flips = [(n, _signed(sum(1 << b for b in c))) for n in range(reach + 1) for c in combinations(range(64), n)]
    table = F.array(*[F.struct(F.lit(n).alias("far"), F.lit(x).alias("flip")) for n, x in flips])
    near = crowd.select("fp", F.explode(table).alias("t")).select(
        F.col("fp").bitwiseXOR(F.col("t.flip")).alias("value"), F.col("t.far").alias("far"), "fp"
    )
    nearest = near.groupBy("value").agg(
        F.min(F.struct("far", "fp")).alias("best"), F.count("*").alias("n")
    )
    nearest = nearest.where("n > 1").select(
        "value", F.col("best.far").alias("best_far"), F.col("best.fp").alias("b")
    )
    return (
        near.join(nearest, "value")
        .where((F.col("far") + F.col("best_far") <= distance) & (F.col("fp") != F.col("b")))
        .select(F.col("fp").alias("a"), "b")
    )


def near_groups(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, fingerprint, component_id, component_size``, and for the
    choice of a row ``tag`` (a hash of its text) and ``stays`` (the row with the smallest
    doc_id, of rows with that doc_id the one with the smallest tag)."""
    rows = materialize(
        raw_text(docs)
        .withColumn("tag", F.xxhash64("raw"))
        .mapInArrow(_prints(shingle), "doc_id long, tag long, fp long"),
        "prints",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "tag"))
    distinct = materialize(
        rows.groupBy("fp").agg(first.alias("first"), F.count("*").alias("n")), "prints"
    )
    found = components(links(distinct.select("fp"), distance))
    placed = distinct.join(found, distinct.fp == found.node, "left").select(
        "fp", "first", "n", F.coalesce("root", "fp").alias("root")
    )
    totals = placed.groupBy("root").agg(F.min("first").alias("chosen"), F.sum("n").alias("size"))
    # written, so that Spark can split a fingerprint that very many rows share
    labels = materialize(
        placed.select("fp", "root").join(totals, "root").select("fp", "chosen", "size"), "labels"
    )
    return rows.join(labels, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("chosen.doc_id").alias("component_id"),
        F.col("size").alias("component_size"),
        "tag",
        (
            F.col("doc_id").eqNullSafe(F.col("chosen.doc_id"))
            & (F.col("tag") == F.col("chosen.tag"))
        ).alias("stays"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component, the one with the smallest doc_id; all
    columns as they are. Rows repeated as a whole count as one document."""
    kept = near_groups(docs).where("stays").select("doc_id", "tag")
    tag = F.xxhash64(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    return keep_rows(docs, kept, tag)
