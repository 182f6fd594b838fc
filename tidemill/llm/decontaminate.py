"""Benchmark items in documents, by latent semantic retrieval.

1. Every text is cut into passages; how many passages hold a word (hashed to 2 ** 16 counters)
   gives the words' weights. All documents count. A word of the benchmark has the larger of its
   weights in the corpus and among the items, or an item that stands in very many documents
   would make its own words common and hide itself.
2. The passages' TF-IDF rows, reduced to the words of the benchmark, and the benchmark's own
   rows, which together weigh as much, are a tall matrix A. One pass over all documents sums
   (A'A) times a random matrix, task by task and then in a tree; from this sketch the leading
   right singular vectors of A follow (randomised SVD, the form for A'A that reads A once).
3. In one more pass every window of every text is projected, and windows whose cosine with an
   item's passage is ``NEAR`` or more are candidates. A window is not projected if the largest
   shares that its words have in any query do not add up to such a cosine; this bound is exact.
   An item of fewer than ``BRIEF`` words is too small a part of a window for a cosine to tell:
   its candidates are all windows that hold as many different words of it as a leak has.
4. A candidate is a leak if the longest common subsequence has ``SURE`` of the item's words, or
   ``LIKELY`` of them and as many of the words of its answer. The answer is what follows the
   last question mark or "answer:", else the last third.

Words are compared in lower case and without ASCII punctuation, by 32 bits of a hash; they are
written once in this form and all passes read that. The benchmark is a stated query set: its
items go through in blocks, each with a bounded vocabulary and fewer rows than the basis has
vectors; one item that is longer than that is a block of its own. Where the leading vectors
have less than ``KEPT`` of a row, the basis gets what they lack, so no row is lost from it.

Defined results: null text is empty; an item without words is never found, one with fewer than
``FEW`` words only as a whole; a document and item give one row, the best place (then the first);
repeated rows give their row each; null ids are kept; items with one text are found together;
an empty table on either side gives an empty result; other columns are ignored, and
``drop_leaks`` hands them on unchanged.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import raw_text, text_groups
from tidemill.llm.words import named
from tidemill.session import materialize

PASSAGE = 64  # words
WINDOW, STEP = 48, 16  # words that are looked at together, and between their first words
COUNTERS = 1 << 16
RANK, EXTRA = 256, 16
ROWS_PER_BLOCK = 240  # rows of items that go through together, fewer than the rank
KEPT = 0.98  # of every row's squared length, that the basis has at least
NEAR = 0.25
SURE, LIKELY = 0.8, 0.6
FEW = 8
BRIEF = 12  # below this many words no cosine is asked; a leak fits a window
LOOSE = 1.3  # a leak may be longer than the item by this
TERMS_PER_BLOCK = 1 << 14  # words of the items that go through together
FAN = 64  # sketches that one group adds up
ROWS = 64  # rows of a sketch that travel together
CODES_AT_ONCE = 1 << 20  # bytes of codes, four of a word, that are worked on together
SEGMENT = 16  # entries of a sparse row that are multiplied together
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all words of all texts, and the number of each word's text."""
    folded = [
        raw.decode("utf-8", "replace").lower().encode().translate(None, PUNCTUATION)
        for raw in texts
    ]
    names, doc = named(folded)
    return (names >> np.uint64(32)).astype(np.uint32), doc


def _write_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for docs, texts in text_groups(batches, "doc_id"):
        codes, doc = codes_of(texts)
        ends = np.searchsorted(doc, np.arange(len(texts) + 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([name for (name,) in docs], pa.int64()),
                pa.array([codes[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
            ],
            names=["doc_id", "codes"],
        )


def word_codes(docs: DataFrame) -> DataFrame:
    """``doc_id, codes`` of every row, written once."""
    return materialize(raw_text(docs).mapInArrow(_write_codes, "doc_id long, codes binary"), "codes")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """The documents of a group, their codes in a row, and the number of each word's text."""
    for docs, parts in text_groups(batches, "doc_id", text="codes", most=CODES_AT_ONCE):
        sizes = [len(part) // 4 for part in parts]
        codes = np.frombuffer(b"".join(parts), dtype=np.uint32)
        yield [name for (name,) in docs], codes, np.repeat(np.arange(len(parts)), sizes)


def _runs(doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first words of stretches of ``width`` words within a text, and their texts."""
    place = np.arange(len(doc), dtype=np.int64)
    first = np.ones(len(doc), dtype=bool)
    first[1:] = doc[1:] != doc[:-1]
    start = place[first][np.cumsum(first) - 1] if len(doc) else place
    heads = np.flatnonzero((place - start) % width == 0)
    return heads, doc[heads]


def _passages(doc: np.ndarray) -> tuple[np.ndarray, int]:
    """The number of each word's passage, and how many there are."""
    heads, _ = _runs(doc, PASSAGE)
    return np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(doc)))), len(heads)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(COUNTERS, dtype=np.int64)
    passages = 0
    for _, codes, doc in _groups(batches):
        passage, number = _passages(doc)
        held = passage * COUNTERS + codes % COUNTERS
        held.sort()
        held = held[np.append(True, held[1:] != held[:-1])] if len(held) else held
        counts += np.bincount(held % COUNTERS, minlength=COUNTERS)
        passages += number
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.append(used, -1), pa.int32()),
            pa.array(np.append(counts[used], passages), pa.int64()),
        ],
        names=["counter", "n"],
    )


def word_weights(rows: DataFrame) -> tuple[np.ndarray, int]:
    """The weight of every counter (inverse passage frequency) and the number of passages."""
    counted = rows.mapInArrow(_count_words, "counter int, n long")
    total = {
        r["counter"]: r["n"]  # COUNTERS + 1 rows at most
        for r in counted.groupBy("counter").agg(F.sum("n").alias("n")).collect()
    }
    passages = total.pop(-1, 0) or 0
    held = np.zeros(COUNTERS)
    held[list(total)] = list(total.values())
    weight = np.log((passages + 1) / (held + 1))
    return weight.astype(np.float32), passages


@dataclass(frozen=True)
class Item:
    item_id: int | None
    codes: list[int]
    answer: int  # the first word of the answer


def read_item(item_id: int | None, text: str) -> Item:
    codes = codes_of([text.encode()])[0].tolist()
    marks = [m.end() for m in re.finditer(r"\?|\banswer:", text, re.IGNORECASE)]
    before = len(codes_of([text[: marks[-1]].encode()])[0]) if marks else 0
    if not 0 < before < len(codes):
        before = len(codes) - -(-len(codes) // 3)
    return Item(item_id, codes, before)


def _starts(item: Item) -> range:
    """The first words of the item's passages, each a query row."""
    return range(0, max(1, len(item.codes) - PASSAGE // 2), PASSAGE)


def item_blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    """The items in the order of their ids, as many at a time as their vocabulary and the
    number of their rows allow."""
    block: list[Item] = []
    seen: set[int] = set()
    parts = 0
    ordered = benchmark.select("item_id", "text").orderBy("item_id", "text")
    for row in ordered.toLocalIterator():
        item = read_item(row["item_id"], row["text"] or "")
        if not item.codes:
            continue
        rows = len(_starts(item))
        terms = len(seen.union(item.codes))
        if block and (terms > TERMS_PER_BLOCK or parts + rows > ROWS_PER_BLOCK):
            yield block
            block, seen, parts = [], set(), 0
        block.append(item)
        seen.update(item.codes)
        parts += rows
    if block:
        yield block


@dataclass(frozen=True)
class Model:
    """What the tasks need of a block of items."""

    items: list[Item]
    parts: list[tuple[int, int]]  # of every query row: its item and its first word there
    vocabulary: np.ndarray  # ascending codes
    own: np.ndarray  # weights of the vocabulary
    weight: np.ndarray  # of all other words, by counter
    basis: np.ndarray  # words of the vocabulary x rank
    queries: np.ndarray  # query rows in the latent space, divided by their lengths
    table: np.ndarray | None  # basis times queries, if the queries are few: one step for two
    most: np.ndarray  # of every word the largest share it has in a projected query
    holds: np.ndarray  # words of the vocabulary x queries: 1 where the query has the word
    needs: np.ndarray  # different words of a query that a window near a leak has at least
    brief: np.ndarray  # whether the query is an item of fewer than BRIEF words
    short: np.ndarray  # whether the word of the vocabulary is in such an item


class Lookup:
    """The weight of words and their place in the vocabulary, or -1."""

    def __init__(self, vocabulary: np.ndarray, own: np.ndarray, weight: np.ndarray):
        self.vocabulary, self.own, self.weight = vocabulary, own, weight
        self.maybe = np.zeros(COUNTERS, dtype=bool)
        self.maybe[vocabulary % COUNTERS] = True

    def of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counter = codes % COUNTERS
        column = np.full(len(codes), -1, dtype=np.int64)
        ask = np.flatnonzero(self.maybe[counter])
        at = np.searchsorted(self.vocabulary, codes[ask]).clip(max=len(self.vocabulary) - 1)
        known = self.vocabulary[at] == codes[ask]
        ask, at = ask[known], at[known]
        column[ask] = at
        weight = self.weight[counter]
        weight[ask] = self.own[at]
        return weight, column


def _sparse(row: np.ndarray, column: np.ndarray, weight: np.ndarray, width: int):
    """Row, column and weight of the TF-IDF entries: (1 + log count) * weight."""
    key, first, count = np.unique(row * width + column, return_index=True, return_counts=True)
    return key // width, key % width, weight[first] * (1 + np.log(count)).astype(np.float32)


def _times(row, column, value, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that have entries, and sparse rows times ``matrix``; rows ascend. Entries go
    through in segments of one row, padded with zeros."""
    if not len(row):
        return row, np.zeros((0, matrix.shape[1]), dtype=matrix.dtype)
    heads = np.concatenate(([0], np.flatnonzero(np.diff(row)) + 1))
    count = np.diff(np.append(heads, len(row)))
    parts = -(-count // SEGMENT)
    first = np.cumsum(parts) - parts  # the first segment of each row
    within = np.arange(len(row)) - np.repeat(heads, count)
    spot = (np.repeat(first, count) + within // SEGMENT) * SEGMENT + within % SEGMENT
    columns = np.zeros((int(parts.sum()), SEGMENT), dtype=np.int64)
    values = np.zeros(columns.shape, dtype=matrix.dtype)
    columns.reshape(-1)[spot], values.reshape(-1)[spot] = column, value
    sums = np.empty((len(columns), matrix.shape[1]), dtype=matrix.dtype)
    for at in range(0, len(columns), 256):
        cut = slice(at, at + 256)
        np.matmul(values[cut, None, :], matrix[columns[cut]], out=sums[cut, None, :])
    total = sums[first]
    for nth in range(1, min(int(parts.max()), SEGMENT)):
        more = np.flatnonzero(parts > nth)
        total[more] += sums[first[more] + nth]
    for long in np.flatnonzero(parts > SEGMENT).tolist():
        total[long] += sums[first[long] + SEGMENT : first[long] + parts[long]].sum(axis=0)
    return row[heads], total


def random_matrix(words: int, columns: int) -> np.ndarray:
    return np.random.default_rng(5).standard_normal((words, columns)).astype(np.float32)


def _sketch(vocabulary: np.ndarray, own: np.ndarray, weight: np.ndarray, columns: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(vocabulary, own, weight)
        width = len(vocabulary)
        omega = random_matrix(width, columns)
        total = np.zeros((width, columns), dtype=np.float32)
        for _, codes, doc in _groups(batches):
            passage, number = _passages(doc)
            value, column = lookup.of(codes)
            other = np.bincount(passage, np.where(column < 0, value**2, 0), number)
            mine = np.flatnonzero(column >= 0)
            row, column, value = _sparse(passage[mine], column[mine], value[mine], width)
            other += np.bincount(row, value**2, number)
            value = value / np.sqrt(np.maximum(other[row], 1e-9)).astype(np.float32)
            rows, image = _times(row, column, value, omega)
            turned = np.argsort(column, kind="stable")
            at = np.searchsorted(rows, row[turned])
            columns_of, sums = _times(column[turned], at, value[turned], image)
            total[columns_of] += sums
        part = TaskContext.get().partitionId()
        cut = range(0, width, ROWS)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([part] * len(cut), pa.int64()),
                pa.array(list(range(len(cut))), pa.int32()),
                pa.array([total[at : at + ROWS].tobytes() for at in cut], pa.binary()),
            ],
            names=["part", "piece", "data"],
        )

    return task


def _added(group: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(group["data"].iloc[0]) // 4, dtype=np.float32)
    for data in group["data"]:
        total += np.frombuffer(data, dtype=np.float32)
    return pd.DataFrame(
        {"part": [group["part"].iloc[0]], "piece": [group["piece"].iloc[0]], "data": [total.tobytes()]}
    )


def corpus_sketch(
    rows: DataFrame, vocabulary: np.ndarray, own: np.ndarray, weight: np.ndarray, columns: int
) -> np.ndarray:
    """(A'A) times the random matrix, summed over all passages of ``rows``. No group adds up
    more than FAN pieces; the result is vocabulary x columns numbers."""
    sums = rows.mapInArrow(
        _sketch(vocabulary, own, weight, columns), "part long, piece int, data binary"
    )
    parts = rows.rdd.getNumPartitions()
    while parts > 1:
        sums = (
            sums.withColumn("part", F.floor(F.col("part") / FAN).cast("long"))
            .groupBy("part", "piece")
            .applyInPandas(_added, "part long, piece int, data binary")
        )
        parts = -(-parts // FAN)
    found = sorted((r["piece"], r["data"]) for r in sums.collect())
    flat = b"".join(data for _, data in found)
    if not flat:
        return np.zeros((len(vocabulary), columns), dtype=np.float32)
    return np.frombuffer(flat, dtype=np.float32).reshape(len(vocabulary), columns)


def _leading(sketch: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """The leading singular vectors from ``sketch`` = C omega with C symmetric and positive."""
    middle = omega.T @ sketch
    values, vectors = np.linalg.eigh((middle + middle.T) / 2)
    good = values > values.max(initial=0) * 1e-6
    if not good.any():
        return np.zeros((len(sketch), 1), dtype=np.float32)
    half = sketch @ (vectors[:, good] / np.sqrt(values[good]))
    left, _, _ = np.linalg.svd(half, full_matrices=False)
    return left[:, :rank].astype(np.float32)


def _completed(basis, row, column, value, number: int) -> tuple[np.ndarray, np.ndarray]:
    """The basis, with more vectors if it has less than KEPT of a query row's squared length,
    and the projected rows. The rows' lengths are 1."""

    def projected(basis: np.ndarray) -> np.ndarray:
        queries = np.zeros((number, basis.shape[1]), dtype=np.float32)
        at, images = _times(row, column, value, basis)
        queries[at] = images
        return queries

    queries = projected(basis)
    weak = np.flatnonzero((queries**2).sum(axis=1) < KEPT)
    if len(weak):
        lost = np.zeros((len(basis), number))
        lost[column, row] = value
        lost = lost[:, weak] - basis @ queries[weak].T
        left, size, _ = np.linalg.svd(lost, full_matrices=False)
        more = left[:, size > 1e-3].astype(np.float32)
        basis = np.ascontiguousarray(np.hstack((basis, more)))
        queries = projected(basis)
    return basis, queries


def fit(rows: DataFrame, items: list[Item], weight: np.ndarray, passages: int) -> Model:
    vocabulary = np.unique(np.array([n for item in items for n in item.codes], dtype=np.uint32))
    width = len(vocabulary)
    parts = [(nth, at) for nth, item in enumerate(items) for at in _starts(item)]
    names = [
        items[nth].codes[at : at + PASSAGE + PASSAGE // 2]
        if at + PASSAGE + PASSAGE // 2 >= len(items[nth].codes)
        else items[nth].codes[at : at + PASSAGE]
        for nth, at in parts
    ]
    flat = np.array([n for part in names for n in part], dtype=np.uint32)
    row = np.repeat(np.arange(len(parts)), [len(part) for part in names])
    column = np.searchsorted(vocabulary, flat)
    count = np.bincount(np.searchsorted(vocabulary, np.concatenate(
        [np.unique(np.array(item.codes, dtype=np.uint32)) for item in items]
    )), minlength=width)
    scarce = np.log((len(items) + 1) / (count + 1)).astype(np.float32)
    own = np.maximum(np.maximum(weight[vocabulary % COUNTERS], scarce), np.float32(1e-3))
    row, column, value = _sparse(row, column, own[column], width)
    length = np.sqrt(np.bincount(row, value**2, len(parts)))
    value = value / np.maximum(length[row], 1e-9).astype(np.float32)
    columns = RANK + EXTRA
    omega = random_matrix(width, columns)
    sketch = corpus_sketch(rows, vocabulary, own, weight, columns).astype(np.float64)
    extra = np.zeros_like(sketch)
    image = np.zeros((len(parts), columns))
    at, images = _times(row, column, value, omega)
    image[at] = images
    np.add.at(extra, column, value[:, None] * image[row])
    sketch += extra * (max(1, passages) / len(parts))
    basis = _leading(sketch, omega.astype(np.float64), RANK)
    basis, queries = _completed(basis, row, column, value, len(parts))
    most = np.zeros(width, dtype=np.float32)
    for at in range(0, len(parts), 1024):
        share = np.abs(basis @ queries[at : at + 1024].T)
        most = np.maximum(most, share.max(axis=1))
    table = basis @ queries.T if len(parts) <= basis.shape[1] else None
    holds = np.zeros((width, len(parts)), dtype=np.float32)
    holds[column, row] = 1
    size = np.array([len(part) for part in names])
    # LIKELY of the words, but for repeated ones, as far as the window that begins at most STEP
    # words before the leak sees it
    needs = (LIKELY * size - (size - holds.sum(axis=0))) * np.minimum(1, (WINDOW - STEP) / size)
    lengths = np.array([len(items[nth].codes) for nth, _ in parts])
    brief, different = lengths < BRIEF, holds.sum(axis=0)
    least = np.where(lengths < FEW, different, np.maximum(1, LIKELY * size - (size - different)))
    needs = np.where(brief, least - 1e-6, needs)
    short = holds[:, brief].any(axis=1)
    return Model(
        items, parts, vocabulary, own, weight, basis, queries, table, most, holds, needs, brief, short
    )


def common_words(item: list[int], text: list[int]) -> int:
    """The length of the longest common subsequence, a bit per word of ``item``."""
    where: dict[int, int] = {}
    for nth, name in enumerate(item):
        where[name] = where.get(name, 0) | 1 << nth
    full = (1 << len(item)) - 1
    rows = full
    for name in text:
        hit = rows & where.get(name, 0)
        if hit:
            rows = ((rows + hit) | (rows - hit)) & full
    return len(item) - rows.bit_count()


def judge(item: Item, text: list[int]) -> tuple[int, bool]:
    """The common words of an item and a stretch of text, and whether it is a leak."""
    size = len(item.codes)
    found = common_words(item.codes, text)
    if size < FEW:
        whole = any(text[i : i + size] == item.codes for i in range(len(text) - size + 1))
        return (size, True) if whole else (found, False)
    if found >= SURE * size:
        return found, True
    answer = item.codes[item.answer :]
    return found, found >= LIKELY * size and common_words(answer, text) >= LIKELY * len(answer)


# a window holds a word WINDOW times at most, so (1 + log n)^2 is at least this part of n
REPEATS = (1 + math.log(WINDOW)) ** 2 / WINDOW


def find_leaks(model: Model, lookup: Lookup, codes: np.ndarray, doc: np.ndarray) -> dict:
    """(text, item) -> (common words, -first word, cosine) of its best leak."""
    best: dict[tuple[int, int], tuple] = {}
    weight, column = lookup.of(codes)
    heads, owner = _runs(doc, STEP)
    ends = np.searchsorted(doc, np.arange(int(doc[-1]) + 1 if len(doc) else 0), side="right")
    stop = np.minimum(heads + WINDOW, ends[owner])
    mine = column >= 0
    square = weight.astype(np.float64) ** 2
    best_of = np.where(mine, weight * model.most[column], 0).astype(np.float64)
    of_brief = np.where(mine, model.short[column], 0).astype(np.float64)
    most, own, other, few = (
        np.diff(np.concatenate(([0.0], np.cumsum(values)))[np.stack((heads, stop))], axis=0)[0]
        for values in (best_of, np.where(mine, square, 0), np.where(mine, 0, square), of_brief)
    )
    rest = other.clip(min=0)
    # no word adds more to a cosine than its weight times its largest share of any query
    length = np.sqrt(rest + REPEATS * own.clip(min=0))
    use = (most > 1e-6) & (most >= NEAR * length)
    if model.brief.any():
        use |= few >= model.needs[model.brief].min()
    use = np.flatnonzero(use)
    for at in range(0, len(use), 2048):
        part = use[at : at + 2048]
        near, query, cosine = _near(model, weight, column, heads[part], stop[part], rest[part])
        for window, which, value in zip(part[near].tolist(), query.tolist(), cosine.tolist()):
            nth, start = model.parts[which]
            item, text = model.items[nth], int(owner[window])
            known = best.get((text, nth))
            if known and known[0] == len(item.codes):
                continue
            # where the item's first word may be, and its last, if it is this passage of it
            low = int(heads[window]) - STEP - int(LOOSE * start)
            high = int(heads[window]) + STEP + 4 + math.ceil(LOOSE * (len(item.codes) - start))
            begin = int(ends[text - 1]) if text else 0
            low, high = max(low, begin), min(high, int(ends[text]))
            common, leak = judge(item, codes[low:high].tolist())
            score = (common, begin - low, value)
            if leak and (known is None or score > known):
                best[(text, nth)] = score
    return best


def _near(model, weight, column, head, stop, rest) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, queries and cosines of all pairs that are near, or hold enough of a brief item."""
    size = stop - head
    row = np.repeat(np.arange(len(head)), size)
    place = np.arange(int(size.sum())) + np.repeat(head - (np.cumsum(size) - size), size)
    mine = column[place] >= 0
    row, place = row[mine], place[mine]
    row, found, value = _sparse(row, column[place], weight[place], len(model.vocabulary))
    length = np.sqrt(rest + np.bincount(row, value**2, len(head)))
    if model.table is not None:
        rows, cosine = _times(row, found, value, model.table)
    else:
        rows, image = _times(row, found, value, model.basis)
        cosine = image @ model.queries.T
    cosine /= length[rows, None].astype(np.float32)
    near, query = np.nonzero((cosine >= NEAR) | model.brief)
    # a subsequence has no more different words than both sides have in common
    some = np.unique(near)
    entries = np.isin(row, rows[some])
    ones = np.ones(int(entries.sum()), dtype=np.float32)
    _, common = _times(row[entries], found[entries], ones, model.holds)
    keep = common[np.searchsorted(some, near), query] >= model.needs[query]
    near, query = near[keep], query[keep]
    return rows[near], query, cosine[near, query]


LEAK_DDL = "doc_id long, item_id long, common_words int, item_words int, first_word long, cosine double"


def _leak_rows(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.vocabulary, model.own, model.weight)
        for docs, codes, doc in _groups(batches):
            found = sorted(find_leaks(model, lookup, codes, doc).items())
            items = [model.items[nth] for (_, nth), _ in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([docs[text] for (text, _), _ in found], pa.int64()),
                    pa.array([item.item_id for item in items], pa.int64()),
                    pa.array([score[0] for _, score in found], pa.int32()),
                    pa.array([len(item.codes) for item in items], pa.int32()),
                    pa.array([-score[1] for _, score in found], pa.int64()),
                    pa.array([score[2] for _, score in found], pa.float64()),
                ],
                names=[f.split()[0] for f in LEAK_DDL.split(", ")],
            )

    return task


def _models(rows: DataFrame, benchmark: DataFrame) -> Iterator[Model]:
    known: tuple[np.ndarray, int] | None = None
    for items in item_blocks(benchmark):
        known = known or word_weights(rows)
        yield fit(rows, items, *known)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs`` and item found in it: ``doc_id, item_id, common_words, item_words,
    first_word`` (about where, among the words that are compared), ``cosine``."""
    rows, found = word_codes(docs), None
    for model in _models(rows, benchmark):
        part = rows.mapInArrow(_leak_rows(model), LEAK_DDL)
        found = part if found is None else found.union(part)
    return docs.sparkSession.createDataFrame([], LEAK_DDL) if found is None else found


def _clean_rows(model: Model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.vocabulary, model.own, model.weight)
        for batch in batches:
            texts = [(text or "").encode() for text in batch["text"].to_pylist()]
            bad = {text for text, _ in find_leaks(model, lookup, *codes_of(texts))}
            yield batch.filter(pa.array([n not in bad for n in range(len(texts))], pa.bool_()))

    return task


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold an item, all columns as they are."""
    clean, rows = docs, word_codes(docs)
    for nth, model in enumerate(_models(rows, benchmark)):
        if nth:
            clean = materialize(clean, "clean")
        clean = clean.mapInArrow(_clean_rows(model), docs.schema)
    return clean
