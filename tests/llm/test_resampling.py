"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from brute import documents, none, odd
from tidemill.llm import resampling as R


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, run):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    runs = [" ".join(words[i : i + n]) for n in range(1, run + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(f.encode()) % R.BUCKETS for f in runs]


def plain(docs, target, run, percent=R.PERCENT, least=R.LEAST_WORDS):
    """Sorted (doc_id, n_features, weight, score, rank); ranks by a plain sort."""
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text, run)[1])
    for text in target:
        t.update(features(text, run)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (all_s + R.BUCKETS) / ((s[b] + 1) * (all_t + R.BUCKETS))))
        for b in s
    }
    rows = []
    for doc, text in docs:
        n_words, buckets = features(text, run)
        weight = sum(gain[b] for b in buckets) // len(buckets) if buckets else 0
        key = f"2024:{'null' if doc is None else doc}"
        h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(buckets), weight, score, None, n_words])
    may = sorted(
        (r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1])
    )
    for place, r in enumerate(may[: len(may) * percent // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def got(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("run", [1, 2, 3])
def test_all_documents_equal_the_plain_version(spark, run):
    docs = documents(spark).select("doc_id", "text")
    target = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = plain(
        [tuple(r) for r in docs.collect()], [r["text"] for r in target.collect()], run, 30
    )
    found = R.resampled(docs, target, run=run, percent=30)
    assert got(found) == want
    assert sum(r[4] is not None for r in want) > 40


def test_the_head_changes_no_result(spark):
    texts = R.raw_text(documents(spark))
    small = R.frequent(texts, 2, 3)
    assert len(small[0]) == len(small[1]) == 3 and b"the" in small[0]
    assert small[0][b"the"] == zlib.crc32(b"the")
    with_head = R.bucket_totals(texts, R.frequent(texts, 2), 2)
    assert (with_head == R.bucket_totals(texts, small, 2)).all()
    assert (with_head == R.bucket_totals(texts, ({}, {}), 2)).all()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=3), max_size=8), st.integers(1, 4))
def test_states_go_on_to_longer_runs(words, run):
    pairs = {a + b" " + b: zlib.crc32(a + b" " + b) for a, b in zip(words[::2], words[1::2])}
    head = (R._States({w: zlib.crc32(w) for w in words[:2]}), pairs)
    for length, codes in enumerate(R.codes_of(words, head, run), 1):
        want = [zlib.crc32(b" ".join(words[i : i + length])) for i in range(len(words) - length + 1)]
        assert codes.tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=400))
def test_a_summary_keeps_what_is_frequent(items):
    summary = R.Summary(5)
    for at in range(0, len(items), 7):
        summary.add(items[at : at + 7])
    for item, n in Counter(items).items():
        assert summary.counts[item] <= n
        assert n <= len(items) / 5 or n - summary.counts[item] <= len(items) / 5 and item in summary.counts
    assert len(summary.counts) <= 17


def test_equal_scores_of_very_many_rows_are_ranked_in_blocks(spark):
    """A third of the rows without doc_id are one text: one score, parted over blocks."""
    same = "one two three " * 10
    rows = [(None, same)] * 200 + [(n, same if n % 2 else f"word{n} " * 25) for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    target = spark.createDataFrame([("one two",)], "text string")
    found = R.resampled(docs, target, percent=60, rows_per_task=50)
    assert got(found) == plain(rows, ["one two"], 1, 60)


def test_odd_rows_and_empty_tables(spark):
    rows = odd(spark)
    pairs = [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()]
    target = spark.createDataFrame([(None, "t"), ("word1 and the", "u")], "text string, doc_id string")
    assert got(R.resampled(rows, target, percent=50)) == plain(pairs, [None, "word1 and the"], 1, 50)
    assert got(R.resampled(rows, target.limit(0))) == plain(pairs, [], 1)
    assert R.resampled(none(spark), target).collect() == []
