"""Recompression of word sequences, in numpy, for many documents at once.

Words have 64-bit names. A round replaces maximal runs of one symbol and then pairs of
neighbours by symbols whose names are mixed from the names of their parts. A pair is taken if
the left one's coin says "left" and the right one's says "right"; coins come from the names, so
the same pair is taken wherever it stands, on any machine, and no two pairs overlap. Names are
global without a dictionary: equal parts have equal names, whoever names them.

Equal passages have the same symbols but near their ends. ``blocks`` gives the symbols of late
rounds, which stand for long passages: where one occurs again, all it holds repeats.
``anchors`` is for the ends that blocks leave. Beside its words, a symbol knows the words that it
depends on: those that, if they are the same elsewhere, force the same symbol there. A window
that holds all of them has this symbol wherever the window occurs. The window's anchor is the
symbol of most words among these, and the window is named by the anchor and by the words that
stand before and after it. Equal windows therefore have equal anchors and equal names, and an
anchor is shared by many windows in a row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidemill.llm.words import BASE, Hashes, mix

ROUNDS = 4  # of pairs before anchors are chosen
RUN_ROUNDS = 1  # of runs among these: each has all symbols depend on both neighbours
REACH = 8  # words that an anchor may depend on
BLOCK_ROUNDS = (12, 18)  # after which symbols count as blocks: about 30 and 180 words
LONGEST = 1 << 20  # words of a symbol
FAR = np.int64(1) << 40  # a place that no window holds
SIZE_BITS = 6  # of an anchor's rank, for its number of words


class Symbols:
    """The symbols of a batch of documents in a row; ``doc`` is the number of the document.
    ``low`` and ``high`` bound the words a symbol depends on, if ``context`` asks for them."""

    def __init__(self, names: np.ndarray, doc: np.ndarray, most: int, context: bool):
        place = np.arange(len(names), dtype=np.int64)
        self.name, self.doc, self.start = names, doc, place
        self.size = np.ones(len(names), dtype=np.int64)
        self.most, self.context = most, context
        self.low, self.high = (place, place + 1) if context else (None, None)

    def _spread(self, low, high, side):
        """Widen by the neighbour on a side; what has none depends on the document's edge."""
        same = np.zeros(len(self.doc), dtype=bool)
        if side > 0:
            same[:-1] = self.doc[1:] == self.doc[:-1]
        else:
            same[1:] = self.doc[1:] == self.doc[:-1]
        other_low, other_high = np.roll(self.low, -side), np.roll(self.high, -side)
        return (
            np.where(same, np.minimum(low, other_low), -FAR),
            np.where(same, np.maximum(high, other_high), FAR),
        )

    def pairs(self, turn: int) -> None:
        if len(self.name) < 2:
            return
        left = (mix(self.name, turn) >> np.uint64(63)).astype(bool)
        take = left[:-1] & ~left[1:] & (self.doc[:-1] == self.doc[1:])
        take &= self.size[:-1] + self.size[1:] <= self.most
        first = np.flatnonzero(take)
        if self.context:
            right_low, right_high = self._spread(self.low, self.high, 1)
            left_low, left_high = self._spread(self.low, self.high, -1)
            low, high = np.where(left, right_low, left_low), np.where(left, right_high, left_high)
            low[first] = np.minimum(low[first], low[first + 1])
            high[first] = np.maximum(high[first], high[first + 1])
            self.low, self.high = low, high
        self.name, self.size = self.name.copy(), self.size.copy()
        self.name[first] = mix(self.name[first] * BASE + mix(self.name[first + 1], 1), 2)
        self.size[first] += self.size[first + 1]
        self._drop(first + 1)

    def runs(self) -> None:
        if len(self.name) < 2:
            return
        change = (self.name[1:] != self.name[:-1]) | (self.doc[1:] != self.doc[:-1])
        start = np.concatenate(([0], np.flatnonzero(change) + 1))
        count = np.diff(np.concatenate((start, [len(self.name)])))
        if self.context:
            low, high = self._spread(self.low, self.high, 1)
            low, high = self._spread(low, high, -1)
            self.low = np.repeat(np.minimum.reduceat(low, start), count)
            self.high = np.repeat(np.maximum.reduceat(high, start), count)
        short = (count > 1) & (self.size[start] * count <= self.most)
        first = start[short]
        if not len(first):
            return
        self.name, self.size = self.name.copy(), self.size.copy()
        self.name[first] = mix(self.name[first] * BASE + count[short].astype(np.uint64), 3)
        self.size[first] *= count[short]
        inside = np.repeat(short, count)
        inside[first] = False
        self._drop(np.flatnonzero(inside))

    def _drop(self, gone: np.ndarray) -> None:
        stay = np.ones(len(self.name), dtype=bool)
        stay[gone] = False
        for field in ("name", "doc", "start", "size", "low", "high"):
            values = getattr(self, field)
            if values is not None:
                setattr(self, field, values[stay])


def recompress(
    names: np.ndarray, doc: np.ndarray, rounds: int, runs: int, most: int, context: bool
) -> Iterator[Symbols]:
    """The symbols after each round; they change as the next one is asked for."""
    symbols = Symbols(names, doc, most, context)
    for turn in range(rounds):
        if turn < runs:
            symbols.runs()
        symbols.pairs(turn)
        yield symbols


def blocks(
    names: np.ndarray, doc: np.ndarray, least: int, after: tuple[int, ...] = BLOCK_ROUNDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of ``least`` words or more after the given rounds: name, a second hash that is
    made from the words alone, first place, number of words."""
    found: list[list[np.ndarray]] = []
    taken = np.zeros(len(names), dtype=np.int64)  # a symbol that stays over rounds counts once
    for turn, symbols in enumerate(recompress(names, doc, max(after), max(after), LONGEST, False), 1):
        if turn in after:
            long = (symbols.size >= least) & (taken[symbols.start] != symbols.size)
            taken[symbols.start[long]] = symbols.size[long]
            found.append([symbols.name[long], symbols.start[long], symbols.size[long]])
    name, start, size = (np.concatenate(x) for x in zip(*found))
    proof = mix(Hashes(names).of(start, start + size), 9)
    return mix(name + size.astype(np.uint64), 4), proof, start, size


class Anchors:
    """For every place at which a window fits in: the key of its anchor, the place from which
    the anchor reaches, and whether the window lies in one document (else the rest means
    nothing).

    A symbol that depends on at most ``reach`` words stands for ``reach`` words from the first
    it depends on, so it is in a window if this first word is among the first
    ``window - reach + 1``; a word by itself depends on none, so every window has an anchor.
    The leftmost of several equal ones is taken, therefore two equal windows have their anchors
    at the same distance and never at the same place.
    """

    def __init__(
        self,
        names: np.ndarray,
        doc: np.ndarray,
        window: int,
        rounds: int = ROUNDS,
        reach: int = REACH,
    ):
        size, reach = len(names), min(reach, window)
        count = max(0, size - window + 1)
        self.window, self.hashes = window, Hashes(names)
        self.name, self.start = names.copy(), np.arange(size, dtype=np.int64)
        self.size = np.ones(size, dtype=np.int64)
        best = self._rank(names, self.size)
        for symbols in recompress(names, doc, rounds, RUN_ROUNDS, reach, True):
            use = np.flatnonzero((symbols.size > 1) & (symbols.high - symbols.low <= reach))
            low, rank = symbols.low[use], self._rank(symbols.name[use], symbols.size[use])
            np.minimum.at(best, low, rank)
            use, low = use[best[low] == rank], low[best[low] == rank]
            for own, other in (
                (self.name, symbols.name),
                (self.start, symbols.start),
                (self.size, symbols.size),
            ):
                own[low[::-1]] = other[use[::-1]]
        place = np.arange(size, dtype=np.int64)
        span, wanted = 1, window - reach + 1
        while span < wanted and count:
            step = min(span, wanted - span)
            later = best[step:] < best[:-step]
            best = np.where(later, best[step:], best[:-step])
            place = np.where(later, place[step:], place[:-step])
            span += step
        self.place = place[:count]
        self.inside = doc[:count] == doc[window - 1 :] if count else np.zeros(0, dtype=bool)
        # the anchor's name, and the other words it reaches over
        used = np.zeros(size + 1, dtype=bool)
        used[self.place] = True
        low = np.flatnonzero(used)
        keys = np.zeros(size + 1, dtype=np.uint64)
        keys[low] = self._named(low, low, low + reach, 7)
        self.key = keys[self.place]

    @staticmethod
    def _rank(name: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The smallest is taken: most words first, then a hash of the name."""
        most = (1 << SIZE_BITS) - 1
        short = (most - np.minimum(size, most)).astype(np.uint64)
        return (short << np.uint64(64 - SIZE_BITS)) | (mix(name, 6) >> np.uint64(SIZE_BITS))

    def _named(self, at, low, high, salt: int) -> np.ndarray:
        """Names of the stretches from ``low`` to ``high`` that hold the symbols of ``at``:
        mixed from the words before, the symbol and the words after it."""
        start = self.start[at]
        end = start + self.size[at]
        before = mix(self.hashes.of(low, start) + (start - low).astype(np.uint64), salt)
        after = mix(self.hashes.of(end, high), salt + 1)
        return mix((before * BASE + self.name[at]) * BASE + after, salt + 2)

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the windows at some places: their names, and a second hash from the words alone."""
        low = np.asarray(at, dtype=np.int64)
        high = low + self.window
        return self._named(self.place[low], low, high, 5), mix(self.hashes.of(low, high), 9)
