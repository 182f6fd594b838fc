"""Hard negatives against a plain version."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import hard_negatives as H

DDL = "vec_id long, embedding array<float>, label int, slot string, score string, v int, nth int"


def plain(rows):
    """Every pair of rows, whole numbers of Python."""
    known = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        v = [math.floor(256 * x) for x in vector]
        known.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, v))
    out = []
    for vec_id, label, v in known:
        if vec_id % 100:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), other, kind) for other, kind, w in known if other != vec_id
        ]
        scored.sort()
        same = [(-s, other) for s, other, kind in scored if kind == label][: H.POSITIVES]
        for mine, positive in same:
            window = [
                (-s, other)
                for s, other, kind in scored
                if kind != label and 30 * mine <= -100 * s <= 90 * mine
            ]
            for nth, (score, other) in enumerate(window[: H.NEGATIVES], 1):
                out.append((vec_id, positive, nth, other, mine, score))
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


def exact(a, b):
    """Modulo 2 ** 64, by Python's whole numbers."""
    whole = a.astype(object) @ b.astype(object)
    return np.vectorize(lambda x: (int(x) + 2**63) % 2**64 - 2**63, otypes=[np.int64])(whole)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 19), st.integers(1, 19), st.integers(1, 19), st.integers(1, 5), st.integers(0, 9))
def test_strassen_equals_the_plain_product_at_every_shape(rows, inner, columns, leaf, seed):
    random = np.random.default_rng(seed)
    a = random.integers(-(2**62), 2**62, (rows, inner))
    b = random.integers(-(2**62), 2**62, (inner, columns))
    assert (H.strassen(a, b, leaf) == exact(a, b)).all()


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 3), st.integers(-4, 4), st.integers(0, 6)), max_size=60),
    st.integers(1, 4),
    st.integers(1, 9),
)
def test_heaps_merge_in_any_parts(entries, size, step):
    """Heaps of parts, merged, are the heap of all."""
    def heap(rows):
        made = H.Heaps(4, size)
        made.add(*(np.array([r[i] for r in rows], dtype=np.int64) for i in range(3)))
        return made

    merged = H.Heaps(4, size)
    for at in range(0, len(entries), step):
        part = heap(entries[at : at + step])
        merged.add(part.slot, part.score, part.vec_id)
    want = [
        row
        for slot in range(4)
        for row in sorted((r for r in entries if r[0] == slot), key=lambda r: (-r[1], r[2]))[:size]
    ]
    assert list(zip(merged.slot, merged.score, merged.vec_id)) == want


def table(spark, rows):
    wide = [(*row, "s", "t", 3, 4) for row in rows]
    return spark.createDataFrame(wide, DDL).repartition(3)


@pytest.fixture(scope="module")
def given_rows(spark):
    read = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    return [(r["vec_id"], r["embedding"], r["label"]) for r in read.collect()]


def test_given_vectors_in_blocks_of_any_size(spark, given_rows):
    want = plain(given_rows)
    assert len(want) > 100
    rows = table(spark, given_rows)
    assert got(H.mined(rows)) == want
    assert got(H.mined(rows, block_bytes=2 * 8 * 64)) == want


def test_tiles_and_strips_smaller_than_the_tables(spark, monkeypatch):
    """Many ties: a vector that a third of the rows have, and few different scores."""
    random = np.random.default_rng(3)
    rows = [
        (n, [0.5, 0.25, 0.125] if n % 3 == 0 else [x / 8 for x in random.integers(0, 4, 3).tolist()], n % 4)
        for n in range(900)
    ]
    monkeypatch.setattr(H, "TILE", 64)  # the driver's side of a test; tasks keep their own
    monkeypatch.setattr(H, "STRIP", 4)
    kept = table(spark, rows)
    assert got(H.mined(kept)) == plain(rows)
    block = H.Block([{"vec_id": r[0], "label": r[2], "v": [math.floor(256 * x) for x in r[1]]} for r in rows[:900:100]])
    heaps = H.Heaps(len(block.vec_id), 5)
    batches = [b for b in H.whole_vectors(kept).toArrow().combine_chunks().to_batches(max_chunksize=50)]
    for at, ids, other, _, scores in block.scored(iter(batches)):
        H._offer(heaps, at + np.arange(len(scores)), other, scores, ids)
    assert len(heaps.slot) == 5 * len(block.vec_id)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 1.0], 1), (1, [1.0, 0.5], 1), (2, None, 1), (3, [1.0, None], 1), (4, [1.0, 1.0], None),
        (5, [float("nan"), 1.0], 2), (6, [float("inf"), 1.0], 2), (8, [0.5, 0.5], 2), (8, [0.5, 0.5], 2),
        (9, [0.5], 3), (10, [], 3), (11, [0.5, 0.25, 9.0], 4), (None, [0.5, 0.5], 2), (100, [], 1),
        (200, [-1.0, -1.0], 1), (300, [0.9, 0.9], 1), (12, [-3.0, 0.2], 1), (13, [0.6, 0.6], 2),
    ]
    assert got(H.mined(table(spark, rows))) == plain(rows) != []
    assert H.mined(table(spark, [])).collect() == []
    assert H.mined(table(spark, rows[1:3])).collect() == []
    repeated = rows + [rows[0]]
    assert got(H.mined(table(spark, repeated))) == plain(repeated)
    # too long for whole scores in longs, and no anchor has a vector of its own length
    assert got(H.mined(table(spark, [*rows, (14, [3e30, 1.0], 2)]))) == plain(rows)
