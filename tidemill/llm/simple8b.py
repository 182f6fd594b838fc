"""Simple-8b: integers in 64-bit words, a selector of four bits and as many ids as fit.

Selectors 2 to 15 stand for (count, bits) in FORMATS. Selector 1 stands for 120 zeros. Selector
0 is the escape: the whole next word is one id that needs more than 60 bits. Every CHUNK ids
start a new word. A block is

    4 bytes  magic "s8b1"
    4 bytes  number of ids, 4 bytes number of words (little-endian)
    4 bytes  each: the number of words before every chunk
    8 bytes  each: the words (little-endian)

so a reader can start at any chunk; ``decode`` treats all words at once, those of one selector
together, and ``pack`` goes through all chunks side by side.
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"s8b1"
CHUNK = 512
ESCAPE, ZEROS, ZERO_RUN = 0, 1, 120
# (ids in a word, bits of an id) of selectors 2 to 15: fixed values of the format
FORMATS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
    (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
_COUNTS = np.array([1, ZERO_RUN] + [count for count, _ in FORMATS], dtype=np.int64)
_LIMITS = np.array([1 << bits for _, bits in FORMATS], dtype=np.uint64)
_SMALL = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.uint8)


def _classes(ids: np.ndarray) -> np.ndarray:
    """For every id the first of FORMATS that holds it; len(FORMATS) for an escape."""
    if not len(ids) or ids.max() < 1 << 16:
        return _SMALL[ids]
    return np.searchsorted(_LIMITS, ids, side="right").astype(np.uint8)


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, and how many come before every chunk. Each word takes the largest number of
    ids that fits from where it stands to the end of its chunk."""
    ids = np.ascontiguousarray(ids, dtype=np.uint64)
    size = len(ids)
    selector = _selectors(_classes(ids), ids)
    step = _COUNTS[selector]
    follows = np.arange(size) + step
    is_head = np.zeros(size, dtype=bool)
    at = np.arange(0, size, CHUNK)
    ends = np.minimum(at + CHUNK, size)
    while len(at):
        is_head[at] = True
        at = follows[at]
        more = at < ends
        at, ends = at[more], ends[more]
    starts = np.flatnonzero(is_head)
    kinds = selector[starts]
    # an escape takes a word more
    place = np.arange(len(starts)) + np.cumsum(kinds == ESCAPE) - (kinds == ESCAPE)
    words = np.zeros(len(starts) + int((kinds == ESCAPE).sum()), dtype=np.uint64)
    words[place] = kinds.astype(np.uint64) << np.uint64(60)
    for kind, (count, bits) in enumerate(FORMATS):
        mine = np.flatnonzero(kinds == kind + 2)
        word = words[place[mine]]
        for nth in range(count if len(mine) else 0):
            word |= ids[starts[mine] + nth] << np.uint64(nth * bits)
        words[place[mine]] = word
    escaped = np.flatnonzero(kinds == ESCAPE)
    words[place[escaped] + 1] = ids[starts[escaped]]
    return words, place[starts % CHUNK == 0]


def _selectors(need: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every id the selector of a word that would start with it."""
    size = len(need)
    rows = -(-size // CHUNK)
    # one row per chunk; past the end nothing fits
    table = np.full((rows, CHUNK), len(FORMATS) + 1, dtype=np.uint8)
    table.reshape(-1)[:size] = need
    out = np.where(table < len(FORMATS), len(FORMATS) + 1, ESCAPE).astype(np.uint8)
    # the largest need among the next ``span`` ids of the chunk; few ids first, so that many
    # overwrite them, and each span at most twice the one before
    widest, span = table, 1
    for kind, (count, _) in reversed(list(enumerate(FORMATS[:-1]))):
        end = CHUNK - count + 1
        widest = np.maximum(widest[:, :end], widest[:, count - span : count - span + end])
        span = count
        if widest.size and widest.min() > kind:  # nor will more ids with fewer bits each fit anywhere
            break
        np.putmask(out[:, :end], widest <= kind, kind + 2)
    if size and not ids.min():
        zero = np.full((rows, CHUNK), 1, dtype=np.uint8)
        zero.reshape(-1)[:size] = ids != 0
        seen = np.cumsum(zero, axis=1, dtype=np.int32)
        seen = np.concatenate((np.zeros((rows, 1), np.int32), seen), axis=1)
        fits = seen[:, ZERO_RUN:] == seen[:, :-ZERO_RUN]
        np.putmask(out[:, : fits.shape[1]], fits, ZEROS)
    return out.reshape(-1)[:size]


def _heads(words: np.ndarray) -> np.ndarray:
    """Which words have a selector, that is, do not follow an escape."""
    head = np.ones(len(words), dtype=bool)
    for at in np.flatnonzero(words >> np.uint64(60) == ESCAPE).tolist():
        if head[at] and at + 1 < len(words):
            head[at + 1] = False
    return head


def _counts(words: np.ndarray) -> np.ndarray:
    """How many ids each word adds; the word after an escape adds none."""
    return np.where(_heads(words), _COUNTS[(words >> np.uint64(60)).astype(np.int64)], 0)


def unpack(words: np.ndarray) -> np.ndarray:
    counts = _counts(words)
    first = np.cumsum(counts) - counts
    ids = np.zeros(int(counts.sum()), dtype=np.uint64)
    kinds = np.where(counts > 0, words >> np.uint64(60), np.uint64(99)).astype(np.int64)
    for kind, (count, bits) in enumerate(FORMATS):
        mine = np.flatnonzero(kinds == kind + 2)
        word, at = words[mine], first[mine]
        for nth in range(count if len(mine) else 0):
            ids[at + nth] = (word >> np.uint64(nth * bits)) & np.uint64((1 << bits) - 1)
    escaped = np.flatnonzero(kinds == ESCAPE)
    ids[first[escaped]] = words[escaped + 1]
    return ids


def encode(ids: np.ndarray) -> bytes:
    words, before = pack(ids)
    head = MAGIC + struct.pack("<II", len(ids), len(words))
    return head + before.astype("<u4").tobytes() + words.astype("<u8").tobytes()


def decode(block: bytes) -> np.ndarray:
    if block[:4] != MAGIC:
        raise ValueError("not a block of this format")
    size, count = struct.unpack_from("<II", block, 4)
    at = 12 + 4 * -(-size // CHUNK)
    ids = unpack(np.frombuffer(block, dtype="<u8", count=count, offset=at))
    if len(ids) != size:
        raise ValueError(f"{len(ids)} ids where the header says {size}")
    return ids
