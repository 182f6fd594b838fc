"""Names of all words of many texts at once, in numpy.

A word is a run of bytes other than the six ASCII blanks. Its name is a polynomial hash of its
bytes, taken from one running sum over the whole batch, and scrambled; equal words have equal
names in every task.
"""

from __future__ import annotations

import numpy as np

from tidemill.llm.common import BLANKS

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2 ** 64
TURN = np.uint64(pow(int(BASE), -1, 1 << 64))
NAMED_AT_ONCE = 1 << 19
_IS_BLANK = np.zeros(256, dtype=bool)
_IS_BLANK[list(BLANKS)] = True
_POWERS: list[np.ndarray] = []


def mix(values: np.ndarray, salt: int) -> np.ndarray:
    """A bijective scrambling of 64-bit values (splitmix)."""
    x = values + np.uint64((salt * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) % (1 << 64))
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


# a byte counts by a scrambled value, so that neighbouring letters are not neighbouring numbers
_BYTES = mix(np.arange(256, dtype=np.uint64), 11)


def _powers(size: int) -> list[np.ndarray]:
    """The powers of BASE and of its inverse, kept from batch to batch."""
    if not _POWERS or len(_POWERS[0]) < size:
        _POWERS.clear()
        for base in (BASE, TURN):
            power = np.full(size, base, dtype=np.uint64)
            power[0] = 1
            _POWERS.append(np.cumprod(power))
    return _POWERS


class Hashes:
    """Hashes of any stretch of a sequence by differences of running sums."""

    def __init__(self, values: np.ndarray):
        power, self.back = _powers(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def of(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return (self.sums[high] - self.sums[low]) * self.back[low]

    def all(self, width: int) -> np.ndarray:
        """Of every stretch of that length."""
        count = len(self.sums) - width
        return (self.sums[width:] - self.sums[:count]) * self.back[:count]


def named(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The names of all words of all texts in order, and the number of each word's text.
    About NAMED_AT_ONCE bytes are in work at a time, as every byte takes forty meanwhile."""
    names, doc = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    start = size = 0
    for at, text in enumerate(texts, 1):
        size += len(text)
        if size >= NAMED_AT_ONCE or at == len(texts):
            part, of = _named(texts[start:at])
            names.append(part)
            doc.append(of + start)
            start, size = at, 0
    return np.concatenate(names), np.concatenate(doc)


def _named(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
    names, low, _ = _spelled(buffer)
    ends = np.cumsum([len(text) + 1 for text in texts])
    return names, np.searchsorted(ends, low, side="right")


def _spelled(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and bounds of the words of a buffer that ends with a blank."""
    blank = _IS_BLANK[buffer]
    first = ~blank
    first[1:] &= blank[:-1]
    last = ~blank[:-1] & blank[1:]
    low, high = np.flatnonzero(first), np.flatnonzero(last) + 1
    return mix(Hashes(_BYTES[buffer]).of(low, high) + (high - low).astype(np.uint64), 12), low, high


def spelled(joined: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names and bounds of all words of a text that ends with a blank, about NAMED_AT_ONCE bytes
    at a time, cut at blanks."""
    buffer = np.frombuffer(joined, dtype=np.uint8)
    start, parts = 0, []
    while start < len(buffer):
        end = start + NAMED_AT_ONCE
        while end < len(buffer) and not _IS_BLANK[buffer[end - 1]]:
            end += 1
        names, low, high = _spelled(buffer[start:end])
        parts.append((names, low + start, high + start))
        start = end
    names, low, high = zip(*parts)
    return np.concatenate(names), np.concatenate(low), np.concatenate(high)
