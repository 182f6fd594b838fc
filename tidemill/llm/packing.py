"""Sequences of at most 2048 tokens by sum-of-squares online packing.

Every task packs the documents of its input split as they come, so nothing is moved. Of a
document longer than a sequence, full pieces are cut off; the rest is placed as one piece. The
level array counts the partly filled windows of each fill level, and a piece goes to the level
(or into a new window) that leaves the sum of the squared counts smallest, the fullest such
level if several do. When the input ends, or when ``MOST_OPEN`` windows are open, the fullest
windows are filled up with pieces of the emptiest ones, cut where needed; the one window that
then is left over is cut into powers of two at the end, which need no padding.

Defined results: null text is empty and has its end id alone; rows with a null or repeated
doc_id are packed like any other; an empty table gives an empty result; other columns are
ignored. A task repeated after a lost executor reads the same split and gives the same rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemill.llm.common import batch_of, raw_text, text_groups
from tidemill.llm.tokens import default_tokenizer, encoder

LENGTH = 2048
MOST_OPEN = 4096  # windows of at most LENGTH ids of four bytes that a task holds
TASK_BITS = 40  # a task numbers its sequences in the low bits

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
PIECE_DDL = ", ".join(f"{f.name} long" for f in PIECE)

Piece = tuple[int | None, int, int, np.ndarray]  # doc_id, start, tokens of the document, ids
Window = list[Piece]


def choose(levels: np.ndarray, size: int) -> int:
    """The fill level to put ``size`` ids on: 0 opens a window. ``levels[h]`` counts the
    windows filled up to h; the entry of the full length stays 0."""
    full = len(levels) - 1
    if size == full:
        return 0
    below, above = levels[1 : full - size + 1], levels[size + 1 :]
    change = 2 * (above - below) + 2
    change[-1] -= 1  # a full window is no longer counted
    change[below == 0] = np.iinfo(np.int64).max
    best = len(change) - 1 - int(np.argmin(change[::-1]))
    return best + 1 if change[best] <= 2 * levels[size] + 1 else 0


class Packer:
    """Windows in the making; ``place`` and ``close`` yield those that are finished."""

    def __init__(self, length: int = LENGTH, most_open: int = MOST_OPEN):
        self.length, self.most_open = length, most_open
        self.levels = np.zeros(length + 1, dtype=np.int64)
        self.open: dict[int, list[Window]] = {}
        self.count = 0

    def place(self, piece: Piece) -> Iterator[Window]:
        doc, start, tokens, ids = piece
        while len(ids) >= self.length:
            yield [(doc, start, tokens, ids[: self.length])]
            start, ids = start + self.length, ids[self.length :]
        if not len(ids):
            return
        # a copy, so that the arrays of the batch can go
        level = choose(self.levels, len(ids))
        window = self.open[level].pop() if level else []
        if level:
            self.levels[level] -= 1
            self.count -= 1
        window.append((doc, start, tokens, ids.copy()))
        yield from self._put(window, level + len(ids))
        if self.count > self.most_open:
            yield from self.fill_up()

    def _put(self, window: Window, level: int) -> Iterator[Window]:
        if level == self.length:
            yield window
        elif level:
            self.levels[level] += 1
            self.count += 1
            self.open.setdefault(level, []).append(window)

    def fill_up(self) -> Iterator[Window]:
        """Fill the fullest windows from the emptiest; at most one stays open."""
        waiting = [(h, w) for h in sorted(self.open, reverse=True) for w in self.open[h]]
        self.open, self.count = {}, 0
        self.levels[:] = 0
        first, last = 0, len(waiting) - 1
        if last < 0:
            return
        level, window = waiting[0]
        while first < last:
            giver = waiting[last][1]
            doc, start, tokens, ids = giver.pop()
            part = ids[: self.length - level]
            window.append((doc, start, tokens, part))
            level += len(part)
            if len(part) < len(ids):
                giver.append((doc, start + len(part), tokens, ids[len(part) :]))
            if not giver:
                last -= 1
            if level == self.length:
                yield window
                first += 1
                if first <= last:
                    window = waiting[first][1]
                    level = sum(len(p[3]) for p in window)
        if first == last and window:
            yield from self._put(window, level)

    def close(self) -> Iterator[Window]:
        """Finish all windows; the last is cut into powers of two."""
        yield from self.fill_up()
        rest = [piece for windows in self.open.values() for window in windows for piece in window]
        left = sum(len(piece[3]) for piece in rest)
        while left:
            room = 1 << (left.bit_length() - 1)
            left -= room
            window: Window = []
            while room:
                doc, start, tokens, ids = rest.pop()
                window.append((doc, start, tokens, ids[:room]))
                if len(ids) > room:
                    rest.append((doc, start + room, tokens, ids[room:]))
                room -= min(room, len(ids))
            yield window


def _pack(tokenizer: str, end: int, length: int, most_open: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(length, most_open)
        number = TaskContext.get().partitionId() << TASK_BITS

        def rows(windows: list[Window]) -> pa.RecordBatch:
            nonlocal number
            out = {f.name: [] for f in PIECE}
            for window in windows:
                at = 0
                for doc, start, tokens, ids in window:
                    out["doc_id"].append(doc)
                    out["start"].append(start)
                    out["length"].append(len(ids))
                    out["ids_crc32"].append(zlib.crc32(np.ascontiguousarray(ids, dtype="<u4")))
                    out["doc_tokens"].append(tokens)
                    out["sequence_id"].append(number)
                    out["offset"].append(at)
                    at += len(ids)
                number += 1
            return batch_of(PIECE, out)

        with encoder(tokenizer) as words:
            for docs, texts in text_groups(batches, "doc_id"):
                ids, bounds = words.encode(texts, end)
                done: list[Window] = []
                for nth, (doc,) in enumerate(docs):
                    part = ids[bounds[nth] : bounds[nth + 1]]
                    done.extend(packer.place((doc, 0, len(part), part)))
                yield rows(done)
        yield rows(list(packer.close()))

    return task


def packed(
    docs: DataFrame,
    tokenizer: str | None = None,
    end: int = 1,
    length: int = LENGTH,
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    task = _pack(tokenizer or default_tokenizer(), end, length, most_open)
    return raw_text(docs).mapInArrow(task, PIECE_DDL)
