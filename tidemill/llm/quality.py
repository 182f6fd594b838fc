"""Quality scores by histogram gradient-boosted trees over statistics of a text.

A text is turned into ``len(FEATURES)`` numbers: letter classes, words, lines and how they
repeat. Trees are fitted on a bounded sample of labelled rows (``SAMPLE`` rows with the smallest
hash of their doc_id, never a held-out one): features are cut into ``BINS`` bins at quantiles of
the sample, and every split is chosen from the histograms of gradients. All trees lie in five
flat arrays, through which numpy walks a whole batch level by level. Scores cover every row in
one pass without a shuffle.

Defined results: null text is empty and scored as such; rows with a null doc_id are scored and
not held out; repeated rows are scored each, and are one row of the sample; labels without a
document or with a null are left out; of several labels of a doc_id the smallest counts; without
labels every score is 0.5, with labels of one kind every score is near that kind; an empty table
gives an empty result; other columns are ignored, and ``reject`` hands them on unchanged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import raw_text

SAMPLE = 20_000  # labelled rows that the trees are fitted on at most
FOLDS, HELD_OUT = 4, 2
GOOD_FROM = 0.7
REJECT_BELOW = 0.5
BINS, TREES, DEPTH, RATE = 48, 80, 4, 0.15
LEAST_ROWS, RIDGE = 15, 1.0

# byte classes: each byte is in one at most
CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "stop": b".,;:",
    "call": b"!?",
    "bar": b"|",
    "symbol": b"#$%&*+/<=>@[]\\^_`{}~",
    "quote": b"'\"()-",
    "blank": b" \t\x0b\x0c",
    "line": b"\n\r",
    "high": bytes(range(128, 256)),
}
FEATURES = [
    *CLASSES, "bytes", "words", "word_bytes", "word_spread", "different", "top_word",
    "same_next", "longest_run", "upper_words", "odd_words", "capital_words", "lines", "line_words",
    "line_spread", "repeated_lines", "letter_spread",
]
_MEMBERS = np.zeros((256, len(CLASSES)))
for _nth, _members in enumerate(CLASSES.values()):
    _MEMBERS[list(_members), _nth] = 1


def features(raw: bytes) -> list[float]:
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    size, n = max(1, len(raw)), max(1, len(words))
    share = count[count > 0] / size
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    kinds = Counter(words)
    run = longest = same = 0
    before = None
    for word in words:
        run = run + 1 if word == before else 1
        same += run > 1
        longest = max(longest, run)
        before = word
    upper = sum(c for w, c in kinds.items() if w.isupper() and len(w) > 1)
    capital = sum(c for w, c in kinds.items() if w[:1].isupper())
    odd = sum(c for w, c in kinds.items() if not w.rstrip(b".,;:").translate(None, _PLAIN) == b"")
    per_line = np.array([line.count(b" ") + 1 for line in lines] or [0], dtype=float)
    return [
        *(count @ _MEMBERS / size).tolist(),
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        float(lengths.mean()) if words else 0.0,
        float(lengths.std()) if words else 0.0,
        len(kinds) / n,
        max(kinds.values(), default=0) / n,
        same / n,
        longest / n,
        upper / n,
        odd / n,
        capital / n,
        float(np.log1p(len(lines))),
        float(per_line.mean()),
        float(per_line.std()),
        1 - len(set(lines)) / max(1, len(lines)),
        float(-(share * np.log2(share)).sum()),
    ]


_PLAIN = CLASSES["lower"] + CLASSES["upper"] + CLASSES["high"]


@dataclass(frozen=True)
class Trees:
    """All trees in flat arrays; a leaf is its own child. ``roots`` are their first nodes."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            for _ in range(DEPTH):
                low = rows[at, self.feature[node]] <= self.cut[node]
                node = np.where(low, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(rows: np.ndarray, good: np.ndarray) -> Trees:
    """Boosted trees for the log-odds of ``good`` (0 or 1)."""
    if not len(rows):
        return _constant(0.0)
    rate = (good.sum() + 0.5) / (len(good) + 1)
    base = float(np.log(rate / (1 - rate)))
    cuts = [np.unique(np.quantile(col, np.linspace(0, 1, BINS + 1)[1:-1])) for col in rows.T]
    binned = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, rows.T)], axis=1)
    nodes: dict[str, list] = {"feature": [], "cut": [], "left": [], "right": [], "value": []}
    roots, margin = [], np.full(len(rows), base)
    for _ in range(TREES):
        chance = 1 / (1 + np.exp(-margin))
        slope, bend = good - chance, chance * (1 - chance)
        roots.append(len(nodes["value"]))
        _grow(nodes, cuts, binned, np.arange(len(rows)), slope, bend, DEPTH, margin)
    arrays = {k: np.array(v, dtype=float if k in ("cut", "value") else int) for k, v in nodes.items()}
    return Trees(**arrays, roots=np.array(roots), base=base)


def _constant(base: float) -> Trees:
    empty = np.zeros(0, dtype=int)
    return Trees(empty, empty, empty, empty, empty, empty, base)


def _grow(nodes, cuts, binned, rows, slope, bend, depth, margin) -> int:
    """Add the node for ``rows`` and all below it; return its number."""
    here = len(nodes["value"])
    g, h = slope[rows].sum(), bend[rows].sum()
    for key, value in (("feature", 0), ("cut", 0.0), ("left", here), ("right", here), ("value", 0.0)):
        nodes[key].append(value)
    best = (1e-6, -1, 0)
    if depth and len(rows) >= 2 * LEAST_ROWS:
        whole = g * g / (h + RIDGE)
        for nth in range(binned.shape[1]):
            bins, width = binned[rows, nth], len(cuts[nth]) + 1
            if width == 1:
                continue
            n = np.cumsum(np.bincount(bins, minlength=width))[:-1]
            gl = np.cumsum(np.bincount(bins, slope[rows], width))[:-1]
            hl = np.cumsum(np.bincount(bins, bend[rows], width))[:-1]
            gain = gl**2 / (hl + RIDGE) + (g - gl) ** 2 / (h - hl + RIDGE) - whole
            gain[(n < LEAST_ROWS) | (len(rows) - n < LEAST_ROWS)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), nth, at)
    _, nth, at = best
    if nth < 0:
        nodes["value"][here] = RATE * g / (h + RIDGE)
        margin[rows] += nodes["value"][here]
        return here
    low = binned[rows, nth] <= at
    nodes["feature"][here], nodes["cut"][here] = nth, float(cuts[nth][at])
    nodes["left"][here] = _grow(nodes, cuts, binned, rows[low], slope, bend, depth - 1, margin)
    nodes["right"][here] = _grow(nodes, cuts, binned, rows[~low], slope, bend, depth - 1, margin)
    return here


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def _matrix(texts: list[bytes]) -> np.ndarray:
    return np.array([features(t) for t in texts]).reshape(len(texts), len(FEATURES))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _matrix(batch["raw"].to_pylist())
        values = pa.array(rows.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["good"], values], names=["doc_id", "good", "features"]
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees fitted on at most ``sample`` labelled rows outside the held-out fold."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("q"))
        .where(F.col("q").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("q").cast("int").alias("good"))
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = (
        raw_text(docs)
        .join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows of two numbers
        .mapInArrow(_describe, "doc_id long, good int, features array<double>")
        .groupBy("doc_id")
        .agg(F.min(F.struct("features", "good")).alias("row"))
        .orderBy("doc_id")
        .collect()
    )
    matrix = np.array([r["row"]["features"] for r in rows], dtype=float)
    return fit(matrix, np.array([r["row"]["good"] for r in rows], dtype=float))


def _score(trees: Trees):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = trees.score(_matrix(batch["raw"].to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

    return task


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, score, predicted``."""
    task = _score(train(docs, labels, sample))
    return (
        raw_text(docs)
        .mapInArrow(task, "doc_id long, score double")
        .select(
            "doc_id",
            held_out(F.col("doc_id")).alias("held_out"),
            "score",
            (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"),
        )
    )


def _good_rows(trees: Trees, least: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(text or "").encode() for text in batch["text"].to_pylist()]
            yield batch.filter(pa.array(trees.score(_matrix(texts)) >= least))

    return task


def reject(
    docs: DataFrame, labels: DataFrame, least: float = REJECT_BELOW, sample: int = SAMPLE
) -> DataFrame:
    """``docs`` without the rows that score below ``least``, all columns as they are."""
    return docs.mapInArrow(_good_rows(train(docs, labels, sample), least), docs.schema)
