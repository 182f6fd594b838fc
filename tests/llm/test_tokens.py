"""Tokens, their files, packing, counts and shards against plain versions."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from tidemill.llm import packing, sharding, simple8b, token_counts, token_files, tokens


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_tokenizer())


def whole(library, text, end):
    return library.encode(text or "", add_special_tokens=False).ids + [end]


ODD_WORDS = st.sampled_from(
    ["the", "The,", "it's", "I'LL", "école", "ÇA!!", "ﬁne", "İs", "a<|endoftext|>b", "x'", "''s",
     "é", "́", "漢字", "12,5", "%%%", "\x1c", "\x85", "　", "\n", "\t", " ", "  ", "ªº", "ŉ"]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(ODD_WORDS, st.text(max_size=6)), max_size=12), st.booleans())
def test_words_encode_as_texts(library, parts, spaced):
    text = (" " if spaced else "").join(parts)
    try:
        raw = text.encode()
    except UnicodeEncodeError:
        return
    with tokens.encoder(tokens.default_tokenizer()) as encoder:
        ids, bounds = encoder.encode([raw, raw], 2)
    want = whole(library, text, 2)
    assert ids.tolist() == want * 2 and bounds.tolist() == [0, len(want), 2 * len(want)]


def test_encoder_forgets(library, monkeypatch):
    monkeypatch.setattr(tokens, "WORDS_KEPT", 3)
    encoder = tokens.WordEncoder(tokens.default_tokenizer())
    for text in ("one two three four", "two five", "", "six, seven"):
        assert encoder.encode([text.encode()], 2)[0].tolist() == whole(library, text, 2)


@settings(max_examples=100, deadline=None)
@given(
    st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1)), max_size=300),
    st.integers(0, 2500),
)
def test_simple8b_round_trip(ids, zeros):
    data = np.array(ids + [0] * zeros + ids[::-1], dtype=np.uint64)
    block = simple8b.encode(data)
    assert (simple8b.decode(block) == data).all()
    words, before = simple8b.pack(data)
    for chunk, start in enumerate(before.tolist()):
        end = before[chunk + 1] if chunk + 1 < len(before) else len(words)
        part = data[chunk * simple8b.CHUNK : (chunk + 1) * simple8b.CHUNK]
        assert (simple8b.unpack(words[start:end]) == part).all()


def test_simple8b_rejects_other_bytes():
    with pytest.raises(ValueError):
        simple8b.decode(b"none" + bytes(8))


def test_token_files(spark, library, monkeypatch):
    for docs in (brute.odd(spark), brute.documents(spark)):
        rows = brute.pairs_of(docs)
        tag = dict(docs.selectExpr("text", "xxhash64(cast(coalesce(text, '') as binary))").collect())
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, tag[r[1]]))
        want, start = [], 0
        for doc, text in rows:
            ids = whole(library, text, 2)
            want.append((doc, start, len(ids), brute.crc(ids)))
            start += len(ids)
        got = token_files.tokenized(docs)
        assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
        assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_files_are_in_order(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write_tokens(brute.documents(spark, brute.MIDDLE).repartition(5), path)
    blocks = spark.read.parquet(path).orderBy("stretch", "block").collect()
    docs = [doc for block in blocks for doc in block.doc_ids]
    assert docs == sorted(docs) and len(docs) == 1000
    assert all(len(simple8b.decode(bytes(b.payload))) == b.n_ids for b in blocks)


def test_choice_has_the_smallest_sum_of_squares():
    rng = np.random.default_rng(3)
    for _ in range(300):
        full = int(rng.integers(3, 40))
        levels = np.zeros(full + 1, dtype=np.int64)
        levels[1:full] = rng.integers(0, 4, full - 1)
        size = int(rng.integers(1, full))

        def after(h):
            new = levels.copy()
            if h:
                new[h] -= 1
            new[h + size] += 1
            return int((new[1:full] ** 2).sum())

        options = [0] + [h for h in range(1, full - size + 1) if levels[h]]
        best = min(map(after, options))
        got = packing.choose(levels, size)
        assert got in options and after(got) == best


def check_packing(rows, library, got, length, end):
    pieces: dict = {}
    sequences: dict = {}
    for r in got:
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at and size > 0
            at += size
        assert at <= length
    want = Counter()
    for doc, text in rows:
        ids = whole(library, text, end)
        want[(doc, len(ids))] += len(ids)
        for start, size, crc in pieces[(doc, len(ids))]:
            if sum(1 for d, t in rows if d == doc) == 1:
                assert crc == brute.crc(ids[start : start + size])
    assert Counter({k: sum(p[1] for p in v) for k, v in pieces.items()}) == want
    fill = [sum(size for _, size in parts) for parts in sequences.values()]
    return sum(0 if f & (f - 1) == 0 else length - f for f in fill), sum(fill)


@pytest.mark.parametrize("length, most_open", [(2048, 4096), (64, 5)])
def test_packing(spark, library, length, most_open):
    for docs in (brute.odd(spark), brute.documents(spark)):
        rows = brute.pairs_of(docs)
        got = packing.packed(docs, length=length, most_open=most_open).collect()
        padding, total = check_packing(rows, library, got, length, 1)
        assert padding <= 0.01 * total + length
        single = [d for d, _ in rows if sum(1 for e, _ in rows if e == d) == 1]
        for doc in single:  # pieces follow each other without gap or overlap
            at = 0
            for r in sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start):
                assert r.start == at
                at += r.length


def ring_walk(keys, shards, vnodes, room):
    """Every key in turn, as far as its arc's stretches go."""
    points = sharding.ring(shards, vnodes)
    places = [p - (1 << 64) if p >> 63 else p for p, _ in points]
    arcs: dict[int, list] = {}
    for key in keys:
        place = key % (1 << 64)
        arc = next((n for n, (p, _) in enumerate(points) if p >= place), 0)
        arcs.setdefault(arc, []).append(key)
    assert len(places) == shards * vnodes
    used = Counter()
    out = {}
    for turn in range(shards):
        for arc in range(len(points)):
            seen: list[int] = []
            for step in range(len(points)):
                owner = points[(arc + step) % len(points)][1]
                if owner not in seen:
                    seen.append(owner)
            waiting = arcs.get(arc, [])
            while waiting and used[seen[turn]] < room[seen[turn]]:
                key = waiting.pop(0)
                out[key] = (seen[0], seen[turn])
                used[seen[turn]] += 1
    return out


def test_shards(spark):
    for docs in (brute.odd(spark), brute.documents(spark, brute.MIDDLE)):
        rows = brute.pairs_of(docs)
        df = sharding.sharded(docs)
        got = df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        want = Counter(
            (d, len((t or "").encode()) + 8, __import__("zlib").crc32((t or "").encode())) for d, t in rows
        )
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
        counts = Counter(r.shard for r in got)
        sizes = [counts[s] for s in range(24)]
        assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(rows)
        slots = Counter((r.shard, r.slot) for r in got)
        assert set(slots) == {(s, n) for s in range(24) for n in range(counts[s])}
        assert {r.law for r in got} == {"rows"} and {r.grown_shard for r in got} == {None}


@pytest.mark.parametrize("cell_rows", [50_000, 20])
def test_ring_against_a_walk(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    keys = spark.range(700).selectExpr(
        "id as doc_id", "xxhash64(id) as place", "0L as text_crc32", "8L as size"
    )
    got = {r.place: (r.home_shard, r.shard) for r in sharding.assign(keys, 5, 3).collect()}
    order = sorted(got, key=lambda p: (p % (1 << 64) >> 60 if cell_rows < 100 else 0, p))
    walk = ring_walk(order, 5, 3, sharding.rooms(700, 5, 0.0))
    assert Counter(s for _, s in walk.values()) == Counter(s for _, s in got.values())
    assert {p: h for p, (h, _) in walk.items()} == {p: h for p, (h, _) in got.items()}
    assert sum(walk[p] != got[p] for p in got) <= 0.02 * len(got)


def test_a_new_shard_moves_little(spark):
    keys = spark.range(20_000).selectExpr(
        "id as doc_id", "xxhash64(id) as place", "0L as text_crc32", "8L as size"
    )

    def places(shards, slack):
        return {r.doc_id: r.shard for r in sharding.assign(keys, shards, slack=slack).collect()}

    before, after = places(24, 0.1), places(25, 0.1)
    moved = sum(before[k] != after[k] for k in before) / len(before)
    assert moved < 0.12  # 1/25 goes to the new shard
    assert max(Counter(before.values()).values()) <= 1.1 * 20_000 / 24 + 1


def test_token_counts(spark, library):
    docs = brute.odd(spark)
    got = {(r.doc_id, r.tokens) for r in token_counts.library_counts(docs).collect()}
    assert got == {(d, len(whole(library, t, 0)) - 1) for d, t in brute.pairs_of(docs)}


def test_rollup(spark, tmp_path):
    rollup = token_counts.Rollup(spark, str(tmp_path / "totals"))
    assert rollup.totals().count() == 0

    def rows(*values):
        return spark.createDataFrame(values, "source string, lang string, tokenizer string, tokens long, bytes long")

    def state():
        return {tuple(r) for r in rollup.totals().collect()}

    first, second = rows(("a", "en", "t", 5, 20), (None, None, "t", 2, 9)), rows(("a", "en", "t", 7, 30))
    rollup.commit(1, token_counts.inserts(first))
    rollup.commit(1, token_counts.inserts(first))
    assert state() == {("a", "en", "t", 1, 5, 20), (None, None, "t", 1, 2, 9)}
    rollup.commit(2, token_counts.inserts(second))
    rollup.compact()
    rollup.commit(2, token_counts.inserts(second))  # already in the base
    assert state() == {("a", "en", "t", 2, 12, 50), (None, None, "t", 1, 2, 9)}
    rollup.commit(3, token_counts.revisions(second, rows(("b", "en", "t", 6, 28))))
    rollup.commit(4, token_counts.deletes(rows((None, None, "t", 2, 9))))
    assert state() == {("a", "en", "t", 1, 5, 20), ("b", "en", "t", 1, 6, 28)}
    rollup.commit(4, token_counts.deletes(rows()))  # an empty batch takes back what it was
    assert (None, None, "t", 1, 2, 9) in state()


def test_a_batch_that_comes_after_a_base_of_later_ones_counts(spark, tmp_path):
    rollup = token_counts.Rollup(spark, str(tmp_path / "totals"))

    def row(tokens):
        return spark.createDataFrame(
            [("a", "en", "t", tokens, 9)], "source string, lang string, tokenizer string, tokens long, bytes long"
        )

    rollup.commit(1, token_counts.inserts(row(1)))
    rollup.commit(3, token_counts.inserts(row(100)))
    rollup.compact()
    rollup.commit(2, token_counts.inserts(row(10)))
    rollup.commit(3, token_counts.inserts(row(900)))  # held already
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "t", 3, 111, 27)]
    rollup.compact()
    rollup.compact()
    assert rollup._base()[1] == [(1, 3)]
    assert [tuple(r) for r in rollup.totals().collect()] == [("a", "en", "t", 3, 111, 27)]


def plain_totals(docs, library):
    """One row of each text without noise stays; every version counts what stays."""
    import re

    kept = {}
    for doc, source, lang, text in docs:
        clean = re.sub(r"[#$%&*|]+", "", text or "")
        place = tuple(x for v in (doc, source, lang) for x in (v is None, v or 0 if v is doc else v or ""))
        if clean not in kept or place < kept[clean][0]:
            kept[clean] = (place, source, lang)
    out = {}
    for clean, (_, source, lang) in kept.items():
        words = clean.encode().split()
        pieces = re.findall(r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]", clean)
        counts = {"words-1": len(words), "pieces-1": len(pieces), "library": len(whole(library, clean, 0)) - 1}
        for name, n in counts.items():
            was = out.get((source, lang, name), (0, 0, 0))
            out[source, lang, name] = (was[0] + 1, was[1] + n, was[2] + len(clean.encode()))
    return {(*k, *v) for k, v in out.items()}


def test_corpus_totals_equal_the_plain_version(spark, library):
    from tidemill.llm.tokens import default_tokenizer

    more = [(1, "one two"), (7, "one two"), (7, "quite another"), (None, "same #"), (None, "same "), (5, "same |")]
    for docs in (brute.odd(spark), brute.documents(spark), spark.createDataFrame(
        [(d, t, "en" if d else None, None if d == 7 else "s") for d, t in more],
        "doc_id long, text string, lang string, source string",
    )):
        got = token_counts.corpus_totals(docs, default_tokenizer(), "library").collect()
        rows = [tuple(r) for r in docs.select("doc_id", "source", "lang", "text").collect()]
        assert {tuple(r) for r in got} == plain_totals(rows, library)


def test_empty_tables(spark):
    docs = brute.none(spark)
    assert packing.packed(docs).count() == 0
    assert token_files.tokenized(docs).count() == 0
    assert sharding.sharded(docs).count() == 0
    assert token_counts.corpus_totals(docs).count() == 0
