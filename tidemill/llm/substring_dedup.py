"""Repeated passages: every word goes that lies in a window of words which starts earlier too.

Recompression (``recompress``) names runs and pairs alike in every task, round by round, so
equal passages become equal symbols. Spark then compares symbols in two rounds:

1. Blocks, the symbols of late rounds, stand for long passages. They meet by name; the first
   occurrence of each stays, and all windows within the others are settled at once, by a row
   for each block. The earliest of equal windows is never settled so, since an earlier block
   would hold an earlier window.
2. What blocks leave, the windows over their edges and in short or partly changed passages,
   goes by small symbols. Anchors, a fraction of the words, meet by name and show which of
   them occur more than once; only windows with such an anchor can repeat. A window is named by
   its anchor and the words before and after it, and the first of each name stays.

Names decide in both rounds: a row of a block or a window carries its symbol's name and, for
proof, 32 bits of a hash made from the words alone. Whole texts move twice, to meet the shared
anchors and to meet what must go.

A task sends an anchor that it has met before straight on as shared, and of the blocks and
windows of a batch only the first of each kind goes on; the first of all is a minimum that is
taken before the shuffle.

Defined results: null text has no words; a text shorter than a window keeps all its words; a
null doc_id comes after all others; rows with one doc_id are documents of their own, in the
order of a hash of their text (62 bits: among a million rows without doc_id the odds that two
texts are taken for one are about one in ten million); rows repeated as a whole are one document, and each shows its
result; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import free_shuffles, raw_text, row_key, text_groups
from tidemill.llm.recompress import Anchors, blocks
from tidemill.llm.words import named
from tidemill.session import materialize

WINDOW = 20
COUNT_BITS = 24  # a stretch of windows is one long: first place, then the number of windows
NEVER = np.iinfo(np.int64).max


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _find_anchors(window: int):
    schema = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("mark", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once = many = np.zeros(0, dtype=np.uint64)
        for group, texts in text_groups(batches, "doc_id", "tag"):
            names, doc = named(texts)
            found = Anchors(names, doc, window)
            anchor, place, whole = found.key, found.place, found.inside
            new = np.ones(len(place), dtype=bool)
            new[1:] = (place[1:] != place[:-1]) | ~whole[:-1]
            at = np.flatnonzero(new & whole)
            order = at[np.argsort(anchor[at], kind="stable")]
            keys, owner = anchor[order], doc[order]
            first = np.ones(len(keys), dtype=bool)
            first[1:] = keys[1:] != keys[:-1]
            count = np.diff(np.append(np.flatnonzero(first), len(keys)))
            unique = keys[first]
            known, met = _among(unique, many), _among(unique, once)
            shared = (count > 1) | known | met
            # the first of each asks, unless the task has already asked as one that repeats
            asks = first.copy()
            asks[first] = ~known
            kind = np.repeat(np.arange(len(unique)), count)
            keep = first.copy()  # one row of a document and anchor
            keep[1:] |= owner[1:] != owner[:-1]
            chosen = np.flatnonzero(keep)
            tags = np.array([tag for _, tag in group], dtype=np.int64)[owner[chosen]]
            mark = tags * 4 + 2 * asks[chosen] + shared[kind[chosen]]
            docs = pa.array([doc_id for doc_id, _ in group], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[chosen].view(np.int64), pa.int64()),
                    docs.take(pa.array(owner[chosen])),
                    pa.array(mark, pa.int64()),
                ],
                schema=schema,
            )
            many = np.union1d(many, unique[shared])
            once = np.union1d(once[~_among(once, many)], unique[~shared])

    return task


def shared_anchors(rows: DataFrame, window: int) -> DataFrame:
    """Per document ``doc_id, tag, anchors``: those of its anchors that occur elsewhere too.

    ``mark`` is four times the tag, plus 2 if the row asks whether its anchor is shared, plus 1
    if that is known already. Rows that ask meet by anchor, two of a task at most; the others
    pass whoever they meet, and are spread by their document and the task that sends them, so
    that copies of one text do not gather.
    """
    found = rows.mapInArrow(_find_anchors(window), "anchor long, doc_id long, mark long")
    asks = F.col("mark").bitwiseAND(2) == 2
    spread = F.when(~asks, F.xxhash64("mark", "doc_id", F.spark_partition_id()))
    group = Window.partitionBy("anchor", "spread")
    told = found.withColumn("spread", spread).withColumn("n", F.count("*").over(group)).where(
        (F.col("mark").bitwiseAND(1) == 1) | (asks & (F.col("n") > 1))
    )
    tag = F.shiftright("mark", 2).alias("tag")
    return told.groupBy("doc_id", tag).agg(F.collect_list("anchor").alias("anchors"))


def _stretches(places: np.ndarray) -> np.ndarray:
    """Ascending places as longs of (first place, number in a row)."""
    if not len(places):
        return places.astype(np.int64)
    breaks = (np.diff(places) != 1) | (np.arange(1, len(places)) % ((1 << COUNT_BITS) - 1) == 0)
    start = np.concatenate(([0], np.flatnonzero(breaks) + 1))
    count = np.diff(np.append(start, len(places)))
    return (places[start] << COUNT_BITS) | count


FOUND = "name long, proof int, doc_id long, tag long, stretch long"
_FOUND = pa.schema(
    [
        ("name", pa.int64()),
        ("proof", pa.int32()),
        ("doc_id", pa.int64()),
        ("tag", pa.int64()),
        ("stretch", pa.int64()),
    ]
)


def _found(group, owner, names, proofs, stretches) -> pa.RecordBatch:
    """Rows of stretches of windows; those without a name are settled."""
    if names is None:
        named = [pa.nulls(len(owner), pa.int64()), pa.nulls(len(owner), pa.int32())]
    else:
        named = [
            pa.array(names.view(np.int64), pa.int64()),
            pa.array(proofs.astype(np.uint32).view(np.int32), pa.int32()),
        ]
    owner = pa.array(owner, pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            *named,
            pa.array([r[0] for r in group], pa.int64()).take(owner),
            pa.array([r[1] for r in group], pa.int64()).take(owner),
            pa.array(stretches, pa.int64()),
        ],
        schema=_FOUND,
    )


def _in_order(group: list[tuple], texts: list[bytes]) -> tuple[list[tuple], list[bytes]]:
    """Rows that begin with (doc_id, tag), in the order that decides what is first; a repeated
    row once."""
    at = {(r[0] is None, r[0] or 0, r[1]): i for i, r in enumerate(group)}
    order = [i for _, i in sorted(at.items())]
    return [group[i] for i in order], [texts[i] for i in order]


def _again(names: np.ndarray, proofs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by name that keeps the rows' own, and which rows in it follow one like them."""
    by = np.lexsort((np.arange(len(names)), proofs, names))
    again = np.zeros(len(by), dtype=bool)
    again[1:] = (names[by[1:]] == names[by[:-1]]) & (proofs[by[1:]] == proofs[by[:-1]])
    return by, again


def _find_blocks(window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, texts in text_groups(batches, "doc_id", "tag"):
            group, texts = _in_order(group, texts)
            names, doc = named(texts)
            start = np.searchsorted(doc, np.arange(len(texts)))
            name, proof, place, size = blocks(names, doc, 2 * window)
            proof = proof >> np.uint64(32)
            order = np.argsort(place, kind="stable")
            name, proof, place, size = name[order], proof[order], place[order], size[order]
            owner = doc[place]
            stretch = ((place - start[owner]) << COUNT_BITS) | (size - window + 1)
            by, again = _again(name, proof)
            go, ask = by[again], by[~again]
            yield _found(group, owner[go], None, None, stretch[go])
            yield _found(group, owner[ask], name[ask], proof[ask], stretch[ask])

    return task


def _settled(settled: list[list[int] | None], start: np.ndarray, size: int) -> np.ndarray:
    """Whether the window at each of ``size`` places is in one of its document's stretches."""
    edge = np.zeros(size + 1, dtype=np.int64)
    for at, stretches in zip(start.tolist(), settled):
        if stretches:
            packed = np.array(stretches, dtype=np.int64)
            low, count = at + (packed >> COUNT_BITS), packed & ((1 << COUNT_BITS) - 1)
            np.add.at(edge, low, 1)
            np.add.at(edge, low + count, -1)
    return np.cumsum(edge[:-1]) > 0


def _find_windows(window: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, texts in text_groups(batches, "doc_id", "tag", "anchors", "settled"):
            group, texts = _in_order(group, texts)
            names, doc = named(texts)
            start = np.searchsorted(doc, np.arange(len(texts)))
            found = Anchors(names, doc, window)
            shared = np.unique(
                np.concatenate([np.array(r[2], dtype=np.int64) for r in group])
            ).view(np.uint64)
            done = _settled([r[3] for r in group], start, len(found.key))
            at = np.flatnonzero(found.inside & ~done & _among(found.key, np.sort(shared)))
            name, proof = found.windows(at)
            proof = proof >> np.uint64(32)
            by, again = _again(name, proof)
            go, ask = np.sort(at[by[again]]), np.sort(by[~again])
            ends = np.append(start[1:], len(names))
            # windows that repeat within the batch are settled; a stretch is one row
            for number in np.unique(doc[go]).tolist():
                low, high = np.searchsorted(go, [start[number], ends[number]])
                rows = _stretches(go[low:high] - start[number])
                yield _found(group, np.full(len(rows), number), None, None, rows)
            owner = doc[at[ask]]
            stretch = ((at[ask] - start[owner]) << COUNT_BITS) | 1
            yield _found(group, owner, name[ask], proof[ask], stretch)

    return task


def later_ones(found: DataFrame) -> DataFrame:
    """``doc_id, tag, stretch`` of all stretches but the first of each name, and of the settled.
    ``found`` is a written table: it is read twice, and Spark may split a name's many rows."""
    here = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "tag", "stretch")
    asks = found.where("name is not null").withColumn("here", here)
    first = asks.groupBy("name", "proof").agg(F.min("here").alias("first"))
    later = asks.join(first, ["name", "proof"]).where("here > first")
    settled = found.where("name is null")
    return later.select("doc_id", "tag", "stretch").union(
        settled.select("doc_id", "tag", "stretch")
    )


def _by_row(stretches: DataFrame, name: str) -> DataFrame:
    key = row_key(F.col("doc_id"), F.col("tag")).alias("row")
    return stretches.groupBy(key).agg(F.collect_list("stretch").alias(name))


def repeated_stretches(rows: DataFrame, window: int) -> DataFrame:
    """Per document ``row, stretches`` of windows that start earlier too; ``row`` is its
    ``row_key``."""
    spark = rows.sparkSession
    long = materialize(rows.mapInArrow(_find_blocks(window), FOUND), "blocks")
    held = materialize(later_ones(long), "held")
    keyed = rows.withColumn("row", row_key(F.col("doc_id"), F.col("tag")))
    asked = shared_anchors(rows, window).select(
        row_key(F.col("doc_id"), F.col("tag")).alias("row"), "anchors"
    )
    windows = materialize(
        keyed.join(asked, "row")
        .join(_by_row(held, "settled"), "row", "left")
        .select("doc_id", "tag", "raw", "anchors", "settled")
        .mapInArrow(_find_windows(window), FOUND),
        "windows",
    )
    free_shuffles(spark)
    gone = materialize(_by_row(later_ones(windows).union(held), "stretches"), "stretches")
    free_shuffles(spark)
    return gone


def kept_words(words: list[bytes], stretches: list[int] | None, window: int) -> list[bytes]:
    if not stretches:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    packed = np.array(stretches, dtype=np.int64)
    low, count = packed >> COUNT_BITS, packed & ((1 << COUNT_BITS) - 1)
    np.add.at(edge, low, 1)
    np.add.at(edge, low + count + window - 1, -1)
    stays = np.cumsum(edge[:-1]) == 0
    return [words[i] for i in np.flatnonzero(stays).tolist()]


def _remove(window: int, texts: bool):
    fields = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64())]
    last = "kept_text" if texts else "kept_sha256"
    schema = pa.schema([*fields, (last, pa.string())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, result = [], [], []
            for raw, stretches in zip(batch["raw"].to_pylist(), batch["stretches"].to_pylist()):
                words = raw.split()
                kept = kept_words(words, stretches, window)
                text = b" ".join(kept)
                total.append(len(words))
                gone.append(len(words) - len(kept))
                result.append(text.decode() if texts else hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(result, pa.string()),
                ],
                schema=schema,
            )

    return task


def tag_of(raw: Column) -> Column:
    """What tells texts of one doc_id, or of none, apart: 62 bits, as a mark has two beside."""
    return F.shiftright(F.xxhash64(raw), 2)


def drop_repeats(docs: DataFrame, window: int = WINDOW, texts: bool = True) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_removed`` and ``kept_text``, the words that
    stay joined by spaces, or only their hash ``kept_sha256``."""
    rows = raw_text(docs).withColumn("tag", tag_of(F.col("raw")))
    gone = repeated_stretches(rows, window)
    keyed = rows.withColumn("row", row_key(F.col("doc_id"), F.col("tag")))
    last = "kept_text" if texts else "kept_sha256"
    return (
        keyed.join(gone, "row", "left")
        .select("doc_id", "raw", "stretches")
        .mapInArrow(
            _remove(window, texts), f"doc_id long, n_words long, n_removed long, {last} string"
        )
    )
