"""Resampling of a corpus towards a target by the words' buckets.

A feature is a run of one to ``run`` words; its bucket is the CRC-32 of its bytes modulo
``BUCKETS``. The logarithm of the bucket's share in the target over its share in the corpus is
its gain, a document's weight is the mean gain of its features, and the documents with the
highest weights plus Gumbel noise are drawn, which is sampling without replacement by weight.

Words have a head and a tail. A first pass keeps a bounded summary of frequent words (and, for
longer runs, frequent pairs) per task; the ``HEAD`` most frequent of all go to every task with
the exact state of their CRC, from which a longer run goes on, and pairs with theirs. All other
features take the CRC of their bytes. Which features are in the head changes no result: both
ways give the same bucket, and totals of buckets are counted over all features of all documents.
Only totals are shuffled, a number per bucket and task. Ranks come from the number of documents
per score, of which there are few, and a position within the score.

Defined results: null text has no words, weight 0 and no rank; a null doc_id has the noise of the
text ``null`` and comes last among equal scores; repeated rows count each, and rows with one
doc_id have one noise; with an empty target all gains fall on the corpus' own shares; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import raw_text, text_groups
from tidemill.plans.ordered import ROWS_PER_TASK, OrderedKeys
from tidemill.session import materialize

BUCKETS = 10_000
RUN = 1
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
HEAD = 8192  # frequent words, and as many pairs, that every task is given
SUMMARY = 2  # a task's summary holds so many times HEAD features

# fixed values: A-Z are lowered; other letters, digits and bytes beyond ASCII stay as they are
_KEPT = set(range(48, 58)) | set(range(97, 123)) | set(range(128, 256))
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c in _KEPT else 32 for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_TABLE).split()


class Summary:
    """Counts of frequent items in bounded memory, mergeable by adding counts up. An item that
    is more than one in ``size`` of all is in it; a count is too low by the same at most."""

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def add(self, items) -> None:
        self.counts.update(items)
        if len(self.counts) > 2 * self.size:
            least = heapq.nlargest(self.size + 1, self.counts.values())[-1]
            self.counts = Counter({k: n - least for k, n in self.counts.items() if n > least})


def _summarise(run: int, size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [Summary(size) for _ in range(min(run, 2))]
        for _, texts in text_groups(batches, "doc_id"):
            for text in texts:
                words = words_of(text)
                kinds[0].add(words)
                if run > 1:
                    kinds[1].add(a + b" " + b for a, b in zip(words, words[1:]))
        for length, kind in enumerate(kinds, 1):
            top = heapq.nlargest(size, kind.counts.items(), key=lambda item: item[1])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([length] * len(top), pa.int32()),
                    pa.array([item for item, _ in top], pa.binary()),
                    pa.array([n for _, n in top], pa.int64()),
                ],
                names=["length", "feature", "n"],
            )

    return task


Head = tuple[dict[bytes, int], dict[bytes, int]]


def frequent(texts: DataFrame, run: int = RUN, head: int = HEAD) -> Head:
    """The CRC states of the ``head`` most frequent words, and pairs if runs are longer."""
    seen = (
        texts.mapInArrow(_summarise(run, SUMMARY * head), "length int, feature binary, n long")
        .groupBy("length", "feature")
        .agg(F.sum("n").alias("n"))
    )
    # counts in bands of a sixteenth of a doubling; only bands that reach into the head are sorted
    band = F.floor(F.log2("n") * 16).cast("int")
    seen = materialize(seen.withColumn("band", band), "frequent")
    sizes = seen.groupBy("length", "band").agg(F.count("*").alias("features")).collect()
    found: Head = ({}, {})
    for length in range(1, min(run, 2) + 1):
        room, least = head, 0
        for row in sorted((r for r in sizes if r["length"] == length), key=lambda r: -r["band"]):
            least = row["band"]
            room -= row["features"]
            if room <= 0:
                break
        high = seen.where((F.col("length") == length) & (F.col("band") >= least))
        for row in high.orderBy(F.desc("n"), "feature").limit(head).collect():
            feature = bytes(row["feature"])
            found[length - 1][feature] = zlib.crc32(feature)
    return found


class _States(dict):
    """The head's states; what is not in it takes the CRC of its bytes and is not kept."""

    def __missing__(self, feature: bytes) -> int:
        return zlib.crc32(feature)


def codes_of(words: list[bytes], head: Head, run: int) -> list[np.ndarray]:
    """The CRCs of all runs of 1, 2, ... ``run`` words."""
    states = list(map(head[0].__getitem__, words))
    out = [np.array(states, dtype=np.int64)]
    known, crc32 = head[1], zlib.crc32
    for length in range(2, run + 1):
        tails = words[length - 1 :]
        if length == 2 and known:
            states = [
                known.get(a + b" " + b) or crc32(b" " + b, state)
                for a, b, state in zip(words, tails, states)
            ]
        else:
            states = [crc32(b" " + b, state) for b, state in zip(tails, states)]
        out.append(np.array(states, dtype=np.int64))
    return out


def _buckets(batches, head: Head, run: int, *names: str):
    """Per group of rows: the named values, the words of each text, the features of each text
    and the bucket of every feature."""
    known: Head = (_States(head[0]), head[1])
    for rows, texts in text_groups(batches, *names):
        counts = np.zeros(len(texts), dtype=np.int64)
        parts = []
        sizes = np.zeros(len(texts), dtype=np.int64)
        if run == 1:
            words: list[bytes] = []
            for nth, text in enumerate(texts):
                here = words_of(text)
                sizes[nth] = len(here)
                words.extend(here)
            counts = sizes
            parts = [np.fromiter(map(known[0].__getitem__, words), np.int64, len(words))]
        else:
            for nth, text in enumerate(texts):
                here = words_of(text)
                sizes[nth] = len(here)
                parts += codes_of(here, known, run)
                counts[nth] = sum(map(len, parts[-run:]))
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        yield rows, sizes, counts, codes % BUCKETS


def _total(head: Head, run: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, dtype=np.int64)
        for *_, buckets in _buckets(batches, head, run, "doc_id"):
            sums += np.bincount(buckets, minlength=BUCKETS)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(sums[used], pa.int64())], names=["bucket", "n"]
        )

    return task


def bucket_totals(texts: DataFrame, head: Head, run: int = RUN) -> np.ndarray:
    """Features per bucket over all ``texts``."""
    parts = texts.mapInArrow(_total(head, run), "bucket long, n long")
    totals = np.zeros(BUCKETS, dtype=np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows
        totals[row["bucket"]] = row["n"]
    return totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln(share in the target / share in the corpus)), one added to each bucket."""
    all_corpus, all_target = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * all_corpus / ((s + 1.0) * all_target)))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        dtype=np.int64,
    )


def _weigh(head: Head, run: int, gain: np.ndarray):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, sizes, counts, buckets in _buckets(batches, head, run, "doc_id"):
            upto = np.concatenate(([0], np.cumsum(gain[buckets])))
            ends = np.cumsum(counts)
            sums = upto[ends] - upto[ends - counts]
            weights = sums // np.maximum(counts, 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([doc_id for (doc_id,) in rows], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(weights, pa.int64()),
                ],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return task


def _noise(seed: int):
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296))).cast("long")


def weighed(docs: DataFrame, target: DataFrame, run: int = RUN, seed: int = SEED) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_features, weight, score``."""
    texts, wanted = raw_text(docs), raw_text(target.select(F.lit(None).alias("doc_id"), "text"))
    head = frequent(texts, run)
    gain = gains(bucket_totals(texts, head, run), bucket_totals(wanted, head, run))
    rows = texts.mapInArrow(
        _weigh(head, run, gain), "doc_id long, n_words long, n_features long, weight long"
    )
    return rows.withColumn("score", F.col("weight") + _noise(seed))


def resampled(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_features, weight, score, rank``; ranked are the
    ``percent`` of the rows of at least ``least_words`` words that score highest."""
    rows = materialize(weighed(docs, target, run, seed), "weights")
    may = F.col("n_words") >= least_words
    drawn = rows.where(may).count() * percent // 100
    # scores are whole numbers of a few tens of thousands, so this table is short
    per_score = rows.where(may).groupBy("score").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")
    high = F.broadcast(per_score.select("score", before.alias("before")).where(F.col("before") < drawn))
    among = (
        rows.where(may).join(high, "score").withColumn("no_id", F.col("doc_id").isNull())
    )
    placed = OrderedKeys(
        among, ["score"], ["no_id", "doc_id", "n_features"], rows_per_task
    ).position("position")
    rank = F.col("before") + F.col("position")
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = placed.select(*columns, F.when(rank <= drawn, rank).alias("rank"))
    none = F.lit(None).cast("long").alias("rank")
    low = rows.where(may).join(high, "score", "left_anti").select(*columns, none)
    return ranked.union(low).union(rows.where(~may).select(*columns, none))
