"""Hard negatives: rows of another label that score somewhat below an anchor's positives.

Vectors become whole numbers, scores are integer inner products. Anchors go through in blocks of
a bounded size; for each block every task multiplies the block with tiles of its rows by
Strassen's recursion on int64 matrices, padded with zeros. Additions wrap modulo 2 ** 64, which
a ring multiplication survives, so a product is exact whenever the score itself fits a long.
A first pass keeps the best rows of an anchor's own label, its positives; a second pass, which
knows their scores, keeps per anchor and positive the best rows of other labels in the window
of scores. What a task keeps is a heap of bounded length per anchor or window; heaps are merged
by keeping the best of what several tasks kept, so only heaps are shuffled. All rows are scored
against all anchors, and nothing but a block, its positives and heaps is ever held.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part, nor does a row without vec_id, which no result could name, nor one whose squared length in
whole numbers is 2 ** 56 or more, whose scores would not fit a long; shorter vectors are filled up
with zeros; every row counts, so repeated rows appear as often as they are there, and a repeated
anchor has its result each time; "other" rows are those with another vec_id; rows with equal score
go by vec_id; an anchor without positives, or a positive without negatives, has no row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import ready
from tidemill.session import materialize, work_path

SCALE = 256
LABELS, SHIFT_EVERY = 10, 7  # labels move on by one where vec_id is divisible by this
ANCHOR_EVERY = 100
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # percent of the positive's score
BLOCK_BYTES = 8 << 20  # of a block of anchors
TILE = 2048  # rows multiplied at once
STRIP = 256  # anchors multiplied at once
LEAF = 32  # a matrix with a side of this or less is multiplied directly
NORM = float(2**56)
NEVER = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices modulo 2 ** 64, by seven products of halves."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    if min(rows, inner, columns) <= leaf:
        return a @ b
    a = np.pad(a, ((0, rows % 2), (0, inner % 2)))
    b = np.pad(b, ((0, inner % 2), (0, columns % 2)))
    r, i, c = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :i], a[:r, i:], a[r:, :i], a[r:, i:]
    b11, b12, b21, b22 = b[:i, :c], b[:i, c:], b[i:, :c], b[i:, c:]
    out = np.empty((2 * r, 2 * c), dtype=np.int64)
    p = strassen(a11 + a22, b11 + b22, leaf)
    out[:r, :c], out[r:, c:] = p, p
    p = strassen(a21 + a22, b11, leaf)
    out[r:, :c] = p
    out[r:, c:] -= p
    p = strassen(a11, b12 - b22, leaf)
    out[:r, c:] = p
    out[r:, c:] += p
    p = strassen(a22, b21 - b11, leaf)
    out[:r, :c] += p
    out[r:, :c] += p
    p = strassen(a11 + a12, b22, leaf)
    out[:r, :c] -= p
    out[:r, c:] += p
    out[r:, c:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:r, :c] += strassen(a12 - a22, b21 + b22, leaf)
    return out[:rows, :columns]


class Heaps:
    """The best ``size`` (score, vec_id) of every slot: higher scores, then smaller ids."""

    def __init__(self, slots: int, size: int):
        self.size = size
        self.worst = np.full(slots, NEVER, dtype=np.int64)  # what a row must reach to come in
        self.slot = np.zeros(0, dtype=np.int64)
        self.score, self.vec_id = self.slot, self.slot

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        """Merge with other entries, also those of other heaps over the same slots."""
        if not len(slot):
            return
        slot = np.concatenate((self.slot, slot))
        score = np.concatenate((self.score, score))
        vec_id = np.concatenate((self.vec_id, vec_id))
        order = np.lexsort((vec_id, -score, slot))
        slot, score, vec_id = slot[order], score[order], vec_id[order]
        first = np.concatenate(([0], np.flatnonzero(np.diff(slot)) + 1))
        count = np.diff(np.append(first, len(slot)))
        place = np.arange(len(slot)) - np.repeat(first, count)
        stay = place < self.size
        self.slot, self.score, self.vec_id = slot[stay], score[stay], vec_id[stay]
        full = count >= self.size
        last = first[full] + self.size - 1
        self.worst[slot[last]] = score[last]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(self.slot), pa.array(self.score), pa.array(self.vec_id)],
            names=["slot", "score", "vec_id"],
        )


HEAP_DDL = "slot long, score long, vec_id long"


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, label, v`` of the rows that take part; ``v`` are whole numbers."""
    ready(embeddings.sparkSession)
    parts = F.transform(F.col("embedding"), lambda x: F.floor(SCALE * x.cast("double")))
    real = F.forall(
        F.col("embedding"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(2.0**40))
    )
    moved = F.when(F.col("vec_id") % SHIFT_EVERY == 0, (F.col("label") + 1) % LABELS)
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    return (
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
        .where("vec_id is not null and label is not null and embedding is not null")
        .where(F.coalesce(real, F.lit(False)))
        .select("vec_id", F.coalesce(moved, F.col("label")).cast("long").alias("label"), parts.alias("v"))
        .where(length < NORM)
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """One row per vector, cut or filled up with zeros to ``width``."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = place < width
    out[row[inside], place[inside]] = values[inside]
    return out


def _tiles(batches: Iterator[pa.RecordBatch], width: int):
    """The rows of all batches in tiles of TILE: ids, labels, a matrix with a column per row.
    What a row has beyond an anchor's ``width`` meets zeros, so it is left out."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        held.append((batch["vec_id"].to_numpy(), batch["label"].to_numpy(), _matrix(batch["v"], width)))
        size += batch.num_rows
        if size >= TILE:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if size:
        yield tuple(map(np.concatenate, zip(*held)))


class Block:
    """Some anchors: their ids, labels and vectors in a matrix."""

    def __init__(self, rows: list):
        self.vec_id = np.array([r["vec_id"] for r in rows], dtype=np.int64)
        self.label = np.array([r["label"] for r in rows], dtype=np.int64)
        self.matrix = np.zeros((len(rows), max(len(r["v"]) for r in rows)), dtype=np.int64)
        for n, r in enumerate(rows):
            self.matrix[n, : len(r["v"])] = r["v"]

    def scored(self, batches: Iterator[pa.RecordBatch]):
        """Per tile and strip of anchors: (first anchor, ids, whether other, whether of the
        anchor's label, scores)."""
        for ids, labels, rows in _tiles(batches, self.matrix.shape[1]):
            turned = np.ascontiguousarray(rows.T)
            for at in range(0, len(self.vec_id), STRIP):
                strip = slice(at, at + STRIP)
                scores = strassen(self.matrix[strip], turned)
                other = self.vec_id[strip, None] != ids
                yield at, ids, other, self.label[strip, None] == labels, scores


def _offer(heaps: Heaps, slots: np.ndarray, may: np.ndarray, scores: np.ndarray, ids: np.ndarray):
    """Offer the scores of a tile that may come in; ``slots`` are those of the rows of ``scores``."""
    may &= scores >= heaps.worst[slots][:, None]
    if scores.shape[1] > heaps.size:
        bar = np.partition(np.where(may, scores, NEVER), -heaps.size, axis=1)[:, -heaps.size]
        may &= scores >= bar[:, None]
    row, column = np.nonzero(may)
    heaps.add(slots[row], scores[row, column], ids[column])


def _positives(block: Block):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(block.vec_id), POSITIVES)
        for at, ids, other, same, scores in block.scored(batches):
            _offer(heaps, at + np.arange(len(scores)), other & same, scores, ids)
        yield heaps.batch()

    return task


def _negatives(block: Block, low: np.ndarray, high: np.ndarray):
    """``low`` and ``high`` bound the scores of every window, POSITIVES windows an anchor; a
    window that is not used has a low above its high."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(low), NEGATIVES)
        for at, ids, other, same, scores in block.scored(batches):
            for nth in range(POSITIVES):
                slots = (at + np.arange(len(scores))) * POSITIVES + nth
                least, most = low[slots][:, None], high[slots][:, None]
                _offer(heaps, slots, ~same & (least <= scores) & (scores <= most), scores, ids)
        yield heaps.batch()

    return task


def _best(heaps: DataFrame, size: int) -> DataFrame:
    """The heaps of all tasks merged: ``slot, score, vec_id`` with ``nth`` from 1."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
    return heaps.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= size)


def _blocks(anchors: DataFrame, most: int) -> Iterator[Block]:
    """All anchors in blocks of at most ``most`` bytes, one at a time."""
    held: list = []
    size = 0
    for row in anchors.toLocalIterator():
        held.append(row)
        size = max(size, 8 * max(1, len(row["v"])))
        if len(held) * size >= most:
            yield Block(held)
            held, size = [], 0
    if held:
        yield Block(held)


def mined(embeddings: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per anchor, positive and negative: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``."""
    spark = embeddings.sparkSession
    rows = materialize(whole_vectors(embeddings), "vectors")
    is_anchor: Column = F.col("vec_id") % ANCHOR_EVERY == 0
    path = work_path(spark, "negatives")
    empty = (
        "anchor_id long, positive_id long, rank int, negative_id long,"
        " positive_score long, negative_score long"
    )
    spark.createDataFrame([], empty).write.parquet(path)
    anchors = materialize(rows.where(is_anchor), "anchors")  # few files, read one by one
    for block in _blocks(anchors, block_bytes):
        found = _best(rows.mapInArrow(_positives(block), HEAP_DDL), POSITIVES).collect()
        count = len(block.vec_id) * POSITIVES  # what a block may have at most
        low, high = np.ones(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        windows = []
        for row in found:
            window = row["slot"] * POSITIVES + row["nth"] - 1
            low[window] = -(-LOW * row["score"] // 100)
            high[window] = HIGH * row["score"] // 100
            windows.append((window, int(block.vec_id[row["slot"]]), row["vec_id"], row["score"]))
        named = spark.createDataFrame(
            windows, "slot long, anchor_id long, positive_id long, positive_score long"
        )
        best = _best(rows.mapInArrow(_negatives(block, low, high), HEAP_DDL), NEGATIVES)
        best.join(F.broadcast(named), "slot").select(
            "anchor_id",
            "positive_id",
            F.col("nth").alias("rank"),
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    return spark.read.schema(empty).parquet(path)
