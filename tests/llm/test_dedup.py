"""Exact copies, near copies, repeated passages and lines against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from tidemill.llm import exact_dedup, line_dedup, recompress, simhash, substring_dedup, words


@pytest.mark.parametrize("bits", [64, 4])
def test_exact_groups(spark, bits):
    """With four bits most chunk hashes clash, so identifiers come from the chunks."""
    for docs in (brute.odd(spark), brute.documents(spark)):
        rows = brute.pairs_of(docs)
        groups: dict[str, list] = {}
        for doc, text in rows:
            groups.setdefault(brute.squeezed(text), []).append(doc)
        got = exact_dedup.exact_groups(docs, bits).collect()
        want = Counter()
        for flat, members in groups.items():
            known = [m for m in members if m is not None]
            sha = hashlib.sha256(flat.encode()).hexdigest()
            for doc in members:
                want[(doc, min(known) if known else None, len(members), sha)] += 1
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        stays = Counter(r.text_sha256 for r in got if r.kept)
        assert set(stays.values()) == {1} and len(stays) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_chunks_are_defined_by_content():
    rng = random.Random(4)
    text = bytes(rng.randrange(97, 123) for _ in range(60_000))
    parts = exact_dedup.chunks_of(text)
    assert b"".join(parts) == text and max(map(len, parts)) <= exact_dedup.MOST
    moved = exact_dedup.chunks_of(b"some words in front " + text)
    assert len(set(parts) & set(moved)) > 0.9 * len(parts)


def test_drop_copies_keeps_rows_whole(spark):
    docs = brute.odd(spark)
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    flat = [brute.squeezed(r.text) for r in got.collect()]
    assert len(flat) == len(set(flat)) == len({brute.squeezed(t) for _, t in brute.pairs_of(docs)})
    assert {tuple(r) for r in got.collect()} <= {tuple(r) for r in docs.collect()}


@pytest.mark.parametrize("pairs_up_to", [32, 1])
@pytest.mark.parametrize("distance", [2, 3, 0])
def test_simhash(spark, monkeypatch, pairs_up_to, distance):
    """With one pair per block all links come from the meetings of crowded blocks."""
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", pairs_up_to)
    if distance == 3 and pairs_up_to == 1:
        pytest.skip("2081 values per fingerprint; covered by test_meetings")
    docs = brute.documents(spark).select("doc_id", "text").union(
        brute.odd(spark).selectExpr("doc_id + 100000", "text")
    )
    rows = brute.pairs_of(docs)
    want = brute.components_of(rows, distance)
    got = simhash.near_groups(docs, distance=distance).collect()
    key = Counter((doc, f"{brute.print_of(t):016x}", want[n]) for n, (doc, t) in enumerate(rows))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == key


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_meetings_link_what_blocks_link(spark, distance):
    rng = random.Random(distance)
    base = rng.getrandbits(64)
    prints = {base}
    for _ in range(30):
        x = base
        for bit in rng.sample(range(64), rng.randrange(1, 6)):
            x ^= 1 << bit
        prints.add(x)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in sorted(prints)]
    frame = spark.createDataFrame(signed, "fp long")

    def roots(edges):
        parent = {p: p for (p,) in signed}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for r in edges.collect():
            assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= distance
            parent[find(r.a)] = find(r.b)
        groups: dict[int, set] = {}
        for p in parent:
            groups.setdefault(find(p), set()).add(p)
        return {frozenset(g) for g in groups.values()}

    assert roots(simhash._meetings(frame, distance)) == roots(simhash.links(frame, distance))


def test_drop_near_copies(spark):
    docs = brute.odd(spark)
    rows = brute.pairs_of(docs)
    got = simhash.drop_near_copies(docs)
    assert got.columns == docs.columns
    groups = brute.components_of(rows, 2)
    named = {g for g in groups.values() if g is not None}
    kept = [r.doc_id for r in got.collect()]
    assert named <= set(kept) and len(kept) == len(set(kept) - {None}) + kept.count(None)
    assert set(kept) - {None} == named


@pytest.mark.parametrize("window", [20, 3])
def test_repeated_passages(spark, window):
    for docs in (brute.odd(spark), brute.documents(spark)):
        rows = brute.pairs_of(docs)
        tag = dict(docs.selectExpr("text", "shiftright(xxhash64(cast(coalesce(text, '') as binary)), 2)").collect())
        order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0, tag[r[1]]))
        want = brute.without_repeats(order, window)
        got = substring_dedup.drop_repeats(docs, window, texts=False).collect()
        assert Counter(tuple(r) for r in got) == Counter((doc, *want[(doc, t)]) for doc, t in rows)


def test_texts_whose_short_hashes_agree_stay_apart(spark):
    """Of 300,000 texts without doc_id, those that share a hash of 32 bits, beside long texts."""
    parts = " ".join(f"c{n}" for n in range(30))
    texts = spark.range(300_000).selectExpr(
        f"case when id % 2 = 0 then concat(id, ' {parts}') else concat(id, ' short') end as text"
    )
    hashed = texts.selectExpr("text", "hash(cast(text as binary)) as h")
    twice = hashed.groupBy("h").count().where("count > 1")
    chosen = [r["text"] for r in hashed.join(twice, "h").select("text").collect()]
    assert len(chosen) > 6
    docs = spark.createDataFrame([(None, t) for t in chosen], "doc_id long, text string").repartition(3)
    got = substring_dedup.drop_repeats(docs, 20).collect()
    long = [t for t in chosen if "short" not in t]
    assert Counter(r.n_words for r in got) == Counter(len(t.split()) for t in chosen)
    assert Counter(r.n_removed for r in got if r.n_words > 2) == Counter({0: 1, 30: len(long) - 1})


def test_common_passage_in_many_documents(spark):
    rng = random.Random(2)
    shared = [f"w{rng.randrange(9)}" for _ in range(60)]
    rows = []
    for doc in range(300):
        own = [f"x{rng.randrange(10**6)}" for _ in range(40)]
        at = rng.randrange(40)
        rows.append((doc, " ".join(own[:at] + shared[rng.randrange(5) :] + own[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = brute.without_repeats(rows, 20)
    got = substring_dedup.drop_repeats(docs, 20)
    assert {(r.doc_id, r.n_words, r.n_removed) for r in got.collect()} == {
        (doc, *want[(doc, t)][:2]) for doc, t in rows
    }


def _batch_of_words(rng, alphabet):
    texts = [[rng.randrange(alphabet) for _ in range(400)] for _ in range(8)]
    for text in texts[1:]:
        text[100:280] = texts[0][37:217]
    return texts, *words.named([" ".join(map(str, t)).encode() for t in texts])


def test_equal_windows_have_equal_anchors():
    rng = random.Random(6)
    for alphabet in (1, 2, 3, 30, 10_000):
        texts, names, doc = _batch_of_words(rng, alphabet)
        found = recompress.Anchors(names, doc, 20)
        at = np.flatnonzero(found.inside)
        named = dict(zip(at.tolist(), zip(*(x.tolist() for x in found.windows(at)))))
        flat = [x for t in texts for x in t]
        by: dict[tuple, list[int]] = {}
        for place in at.tolist():
            by.setdefault(tuple(flat[place : place + 20]), []).append(place)
        assert len(by) == len(set(named.values()))
        assert len(by) == len({n for n, _ in named.values()}) == len({p for _, p in named.values()})
        for places in by.values():
            assert len({named[p] for p in places}) == 1
            assert len({int(found.key[p]) for p in places}) == 1
            assert len({int(found.place[p]) for p in places}) == len(places)


def test_blocks_are_equal_where_their_words_are():
    rng = random.Random(7)
    for alphabet in (1, 2, 30, 10_000):
        texts, names, doc = _batch_of_words(rng, alphabet)
        flat = [x for t in texts for x in t]
        name, proof, start, size = recompress.blocks(names, doc, 20, (7, 12))
        held: dict[int, set] = {}
        for n, p, at, long in zip(*(x.tolist() for x in (name, proof, start, size))):
            assert doc[at] == doc[at + long - 1] and long >= 20
            held.setdefault(n, set()).add((p, tuple(flat[at : at + long])))
        assert len(set(zip(start.tolist(), size.tolist()))) == len(name)
        assert len(name) and all(len(same) == 1 for same in held.values())
        assert len({next(iter(same)) for same in held.values()}) == len(held)
        if alphabet > 2:  # the shared passage of all eight gives blocks that all eight have
            assert max(Counter(name.tolist()).values()) >= 8
        else:  # runs of one word are one symbol
            assert alphabet == 2 or set(size.tolist()) == {400}


def _symbols_of(task, rows):
    batch = pa.RecordBatch.from_pylist(
        rows, pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("raw", pa.binary())])
    )
    out = [row for part in task(iter([batch])) for row in part.to_pylist()]
    return {row.get("name", row.get("anchor")) for row in out} - {None}


@pytest.mark.parametrize("find", [substring_dedup._find_blocks, substring_dedup._find_anchors])
def test_names_of_symbols_decide(find, monkeypatch):
    """Two tasks meet by the names of runs and pairs: if one names them otherwise, the passage
    that they share is not found."""
    rng = random.Random(8)
    shared = [f"s{rng.randrange(10**6)}" for _ in range(600)]
    rows = [
        [{"doc_id": n, "tag": 1, "raw": " ".join([f"o{n}"] * 3 + shared + [f"p{n}"]).encode()}]
        for n in range(2)
    ]
    first = _symbols_of(find(20), rows[0])
    assert len(first & _symbols_of(find(20), rows[1])) > len(first) // 2 > 1
    true = recompress.mix
    named_otherwise = lambda values, salt: true(values, salt + 100 * (salt == 2))
    monkeypatch.setattr(recompress, "mix", named_otherwise)
    other = _symbols_of(find(20), rows[1])
    assert len(other) > 1 and len(first & other) <= len(first) // 8


def test_long_copies_are_settled_by_blocks(spark):
    """Copies in other partitions cost rows of blocks, and windows only at the blocks' edges."""
    rng = random.Random(9)
    text = [f"w{rng.randrange(500)}" for _ in range(3000)]
    rows = [(doc, " ".join([f"own{doc}", *text])) for doc in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    raw = substring_dedup.raw_text(docs).withColumn("tag", substring_dedup.tag_of(F.col("raw")))
    found = raw.mapInArrow(substring_dedup._find_blocks(20), substring_dedup.FOUND).cache()
    later = substring_dedup.later_ones(found).collect()
    held = Counter()
    for row in later:
        held[row.doc_id] += row.stretch & ((1 << substring_dedup.COUNT_BITS) - 1)
    assert held[0] == 0 and min(held[doc] for doc in range(1, 12)) > 2000
    assert found.count() < 12 * 3000 / 10
    want = brute.without_repeats(rows, 20)
    got = substring_dedup.drop_repeats(docs, 20, texts=False).collect()
    assert {tuple(r) for r in got} == {(doc, *want[(doc, t)]) for doc, t in rows}


def test_word_names():
    texts = [b"", b" ", b"one", b"two  one\n", b"\x1cx \x0b y\x0cone", "é é".encode()]
    names, doc = words.named(texts)
    plain = [w for t in texts for w in t.split()]
    assert len(names) == len(plain)
    assert doc.tolist() == [n for n, t in enumerate(texts) for _ in t.split()]
    assert len(set(zip(names.tolist(), plain))) == len(set(plain)) == len(set(names.tolist()))


@pytest.mark.parametrize("sites", [2, 10])
def test_lines(spark, sites):
    for docs in (brute.odd(spark), brute.documents(spark, brute.MIDDLE)):
        rows = [(r.doc_id, r.text or "", r.source) for r in docs.collect()]
        seen: dict[str, set] = {}
        for _, text, source in rows:
            for line in text.split("\n"):
                seen.setdefault(line, set()).add(source)
        wide = {line for line, where in seen.items() if line and len(where) >= sites}
        got = line_dedup.drop_boilerplate(docs, sites).collect()
        want = Counter()
        for doc, text, _ in rows:
            lines = text.split("\n")
            kept = [x for x in lines if x not in wide]
            want[(doc, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
        assert Counter(tuple(r) for r in got) == want


def test_empty_tables(spark):
    docs = brute.none(spark)
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.drop_copies(docs).columns == docs.columns
    assert simhash.near_groups(docs).count() == 0
    assert simhash.drop_near_copies(docs).count() == 0
    assert substring_dedup.drop_repeats(docs).count() == 0
    assert line_dedup.drop_boilerplate(docs).count() == 0
