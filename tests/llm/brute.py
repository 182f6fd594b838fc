"""Plain versions of the operators, and tables with all the odd cases."""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections import Counter

import numpy as np
import xxhash

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"

# columns that the operators use as names of their own
DDL = (
    "doc_id long, text string, lang string, source string, n_chars long, kept boolean, raw int,"
    " tag string, row string, score double, fp long, place long, shard int, keep_id long"
)


def odd_rows() -> list[tuple]:
    long = " ".join(f"word{i % 977} and {i}" for i in range(40_000))
    texts = [
        (1, "one two three"), (2, "one  two\tthree"), (3, None), (4, ""), (5, " "), (6, "\n\n"),
        (7, "one two three"), (7, "one two three"), (8, "x" * 20_000), (9, long), (10, long),
        (None, "one two three"), (None, "nobody's text"), (None, None), (12, "A b"), (13, "a B"),
        (14, "é è ü ß 漢字 　 wide"), (15, "the " * 500), (16, "the " * 500 + "end"),
        (17, "|".join(["a"] * 300)), (18, "\x1c\x1d odd \x85 blanks  "), (7, "another seven"),
    ]
    return [
        (i, t, None if n % 5 == 0 else "en", None if n % 4 == 0 else f"s{n % 3}", n, True, 1, "t",
         "r", 0.5, 9, 8, 7, 6)
        for n, (i, t) in enumerate(texts)
    ]


def odd(spark):
    return spark.createDataFrame(odd_rows(), DDL).repartition(3)


def none(spark):
    return spark.createDataFrame([], DDL)


def documents(spark, root=SMALL):
    return spark.read.parquet(f"{root}/documents.parquet")


def pairs_of(df) -> list[tuple]:
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def squeezed(text) -> str:
    out, blank = [], False
    for c in text or "":
        if c in " \t\n\x0b\x0c\r":
            if not blank:
                out.append(" ")
            blank = True
        else:
            out.append(c)
            blank = False
    return "".join(out)


def print_of(text, shingle=3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    votes = [0] * 64
    for part in parts:
        h = xxhash.xxh64_intdigest(part, 42)
        for bit in range(64):
            votes[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * votes[bit] > len(parts))


def components_of(rows, distance) -> dict:
    """(doc_id, text) rows -> row number -> smallest doc_id of its component."""
    prints = [print_of(t) for _, t in rows]
    kinds = sorted(set(prints))
    array = np.array(kinds, dtype=np.uint64)
    parent = list(range(len(kinds)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(kinds)):
        near = np.bitwise_count(array ^ array[i]) <= distance
        for j in np.flatnonzero(near).tolist():
            parent[find(i)] = find(j)
    where = {p: find(i) for i, p in enumerate(kinds)}
    low: dict[int, int | None] = {}
    for (doc, _), p in zip(rows, prints):
        known = low.get(where[p])
        low[where[p]] = known if doc is None else doc if known is None else min(doc, known)
    return {n: low[where[p]] for n, p in enumerate(prints)}


def without_repeats(rows, window) -> dict:
    """{(doc_id, text): (words, removed, sha256)}; documents are distinct (doc_id, text)."""
    seen, out = set(), {}
    for doc, text in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen:
                gone[at : at + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[(doc, text)] = (len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def crc(ids) -> int:
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def lcs(a, b) -> int:
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def statistics(raw: bytes) -> dict:
    """The numbers that the quality classifier knows of a text, one after another."""
    text = [bytes([c]) for c in raw]
    size = max(1, len(raw))
    share = lambda test: sum(map(test, text)) / size
    words, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    n = max(1, len(words))
    runs = [len(list(same)) for _, same in itertools.groupby(words)]
    mean = lambda x: sum(x) / len(x) if x else 0.0
    spread = lambda x: math.sqrt(max(0, mean([v * v for v in x]) - mean(x) ** 2))
    lengths = [len(w) for w in words]
    blanks = [line.count(b" ") + 1 for line in lines]
    letters = [raw.count(c) / size for c in set(raw)]

    def is_odd(word):
        return any(c < 128 and not chr(c).isalpha() for c in word.rstrip(b".,;:"))

    return {
        "lower": share(bytes.islower), "upper": share(bytes.isupper), "digit": share(bytes.isdigit),
        "stop": share(lambda c: c in b".,;:"), "call": share(lambda c: c in b"!?"),
        "bar": share(lambda c: c == b"|"), "symbol": share(lambda c: c in b"#$%&*+/<=>@[]\\^_`{}~"),
        "quote": share(lambda c: c in b"'\"()-"), "blank": share(lambda c: c in b" \t\x0b\x0c"),
        "line": share(lambda c: c in b"\n\r"), "high": share(lambda c: c > b"\x7f"),
        "bytes": math.log(1 + len(raw)), "words": math.log(1 + len(words)),
        "word_bytes": mean(lengths), "word_spread": spread(lengths),
        "different": len(set(words)) / n, "top_word": max(Counter(words).values(), default=0) / n,
        "same_next": sum(a == b for a, b in zip(words, words[1:])) / n,
        "longest_run": max(runs, default=0) / n,
        "upper_words": sum(w.isupper() and len(w) > 1 for w in words) / n,
        "odd_words": sum(map(is_odd, words)) / n,
        "capital_words": sum(w[:1].isupper() for w in words) / n,
        "lines": math.log(1 + len(lines)), "line_words": mean(blanks), "line_spread": spread(blanks),
        "repeated_lines": 1 - len(set(lines)) / max(1, len(lines)),
        "letter_spread": -sum(x * math.log2(x) for x in letters),
    }


def boosted(rows, good, trees, depth, bins, rate, least, ridge):
    """Scores of ``rows`` by trees whose splits come from trying every quantile of every column."""
    rows, good = np.asarray(rows, dtype=float), np.asarray(good, dtype=float)
    chance = (good.sum() + 0.5) / (len(good) + 1)
    margin = np.full(len(rows), math.log(chance / (1 - chance)))
    cuts = [sorted(set(np.quantile(col, [k / bins for k in range(1, bins)]))) for col in rows.T]

    def grow(inside, depth, slope, bend, step):
        gain_of = lambda part: slope[part].sum() ** 2 / (bend[part].sum() + ridge)
        best, split = 1e-6, None
        for column in range(rows.shape[1]) if depth and inside.sum() >= 2 * least else ():
            for cut in cuts[column]:
                low = inside & (rows[:, column] <= cut)
                high = inside & ~low
                if min(low.sum(), high.sum()) >= least:
                    gain = gain_of(low) + gain_of(high) - gain_of(inside)
                    if gain > best + 1e-9:
                        best, split = gain, (low, high)
        if split:
            for part in split:
                grow(part, depth - 1, slope, bend, step)
        else:
            step[inside] = rate * slope[inside].sum() / (bend[inside].sum() + ridge)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(rows))
        grow(np.ones(len(rows), dtype=bool), depth, good - p, p * (1 - p), step)
        margin = margin + step
    return 1 / (1 + np.exp(-margin))


def largest_share(items, text, common, least=0.5) -> float:
    """The largest part of an item's words that a stretch of ``text`` has in their order, 0 if
    it is below ``least``; ``common(item, stretch)`` is the longest common subsequence."""
    best, whole = 0.0, Counter(text)
    for item in items:
        held = sum(min(n, whole[w]) for w, n in Counter(item).items())
        if held < max(best, least) * len(item):
            continue
        width = int(1.3 * len(item)) + 4
        for at in range(0, max(1, len(text) - len(item) // 2), 4):
            best = max(best, common(item, text[at : at + width]) / len(item))
    return best
