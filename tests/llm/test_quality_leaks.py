"""The classifier, the search for benchmark items, the pipeline and the registered queries."""

import random

import numpy as np
import pytest

import brute
import corpus_pipeline
from oracle import connect, difference
from tidemill.llm import decontaminate, quality
from tidemill.llm.queries import ORACLES, QUERIES

LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs = brute.documents(spark, LARGE)
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    scores = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    assert len(scores) == docs.count()
    known = [(scores[r.doc_id], r.quality) for r in labels.collect() if r.quality is not None]
    held = [(s, q) for s, q in known if s.held_out]
    assert len(held) > 500
    assert np.mean([s.predicted == q for s, q in held]) > 0.97
    assert np.mean([s.score >= quality.REJECT_BELOW for s, q in held if q == 1]) > 0.99
    assert all(0 <= s.score <= 1 and s.predicted == (s.score >= 0.7) for s in scores.values())


def test_held_out_rows_teach_nothing(spark):
    docs = brute.documents(spark, brute.MIDDLE)
    labels = spark.read.parquet(f"{brute.MIDDLE}/labels.parquet")
    held = quality.held_out(labels["doc_id"])
    flipped = labels.withColumn("quality", (1 - labels["quality"]).cast("int"))
    mixed = labels.where(~held).union(flipped.where(held))
    one = quality.train(docs, labels)
    two = quality.train(docs, mixed)
    assert (one.value == two.value).all() and (one.cut == two.cut).all()


def test_flat_trees_are_the_trees():
    rng = np.random.default_rng(1)
    rows = rng.random((400, len(quality.FEATURES)))
    good = (rows[:, 3] + rows[:, 7] > 1).astype(float)
    trees = quality.fit(rows, good)

    def walk(row):
        total = trees.base
        for root in trees.roots:
            node = root
            while trees.left[node] != node:
                low = row[trees.feature[node]] <= trees.cut[node]
                node = trees.left[node] if low else trees.right[node]
            total += trees.value[node]
        return 1 / (1 + np.exp(-total))

    scores = trees.score(rows)
    assert np.allclose(scores, [walk(r) for r in rows])
    assert np.mean((scores > 0.5) == good) > 0.95


def test_statistics_of_a_text():
    texts = [(t or "").encode() for _, t, *_ in brute.odd_rows()][:8] + [
        "Ein Satz, noch ein Satz.\n\n  Ein Satz, noch ein Satz.\nEND\tEND END! (a|b) 3.14 [x]=y_z `q` \\".encode(),
        "É è |漢字| 'x' --\r\n\x0b#1 #1 #1 A ABC Abc aBC x1: 1x;".encode(),
    ]
    for raw in texts:
        want = brute.statistics(raw)
        assert list(want) == quality.FEATURES
        assert np.allclose(quality.features(raw), list(want.values())), raw


def test_histograms_find_the_best_splits(monkeypatch):
    """Against trying every cut of every column row by row; ties among columns aside."""
    monkeypatch.setattr(quality, "TREES", 4)
    rng = np.random.default_rng(7)
    rows = np.column_stack([rng.random(260), rng.integers(0, 5, 260), rng.normal(size=260), np.ones(260)])
    for seed in range(3):
        noise = np.random.default_rng(seed).random(260)
        good = ((rows[:, 0] > 0.4) & (rows[:, 1] < 3) | (noise > 0.9)).astype(float)
        want = brute.boosted(
            rows, good, 4, quality.DEPTH, quality.BINS, quality.RATE, quality.LEAST_ROWS, quality.RIDGE
        )
        assert np.allclose(quality.fit(rows, good).score(rows), want)


def test_quality_odd_cases(spark):
    docs = brute.odd(spark)
    ddl = "doc_id long, quality int, toxic int, score double"
    for rows in ([], [(1, None, 0, 0.0)], [(1, 1, 0, 0.0), (1, 0, 0, 0.0), (None, 1, 0, 0.0), (99, 1, 0, 0.0)]):
        labels = spark.createDataFrame(rows, ddl)
        got = quality.scored(docs, labels).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
        kept = quality.reject(docs, labels, least=0.0)
        assert kept.columns == docs.columns and kept.count() == docs.count()
    assert quality.scored(brute.none(spark), labels).count() == 0


def plant(rng, items, count):
    """Texts, and for each the item it holds and how much it was changed."""
    texts, held = [], []
    for doc in range(count):
        own = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(150, 400))]
        kind = doc % 5
        nth = rng.randrange(len(items))
        part = items[nth].split()
        if kind == 1:  # paraphrase: some words replaced, some words put in
            part = [w if rng.random() > 0.12 else f"n{rng.randrange(999)}" for w in part]
            part.insert(len(part) // 2, "indeed")
        elif kind == 2:  # less than half of it
            part = part[: int(0.45 * len(part))]
        elif kind == 3:
            part = [w.upper() + "," for w in part]
        elif kind == 4:
            part = []
        at = rng.randrange(len(own))
        texts.append(" ".join(own[:at] + part + own[at:]))
        held.append((nth, kind))
    return texts, held


def test_leaks_against_all_windows(spark):
    rng = random.Random(8)
    items = [" ".join(f"v{rng.randrange(3000)}" for _ in range(rng.choice([12, 30, 55, 150]))) for _ in range(40)]
    texts, held = plant(rng, items, 250)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.leaks(docs, bench).collect()}
    want = set()
    for doc, (nth, kind) in enumerate(held):
        item = items[nth].lower().split()
        text = [w.strip(",") for w in texts[doc].lower().split()]
        width = int(1.3 * len(item)) + 4
        share = max(brute.lcs(item, text[at : at + width]) for at in range(0, len(text), 4)) / len(item)
        assert kind != 4 or share < 0.6
        if share >= 0.8:
            want.add((doc, nth))
    exact = {(doc, nth) for doc, (nth, kind) in enumerate(held) if kind in (0, 3)}
    assert len(want) > 100 and exact <= want
    assert exact <= set(got)
    assert len(want & set(got)) >= 0.9 * len(want)
    for (doc, item), r in got.items():
        nth, kind = held[doc]
        assert item == nth and kind in (0, 1, 3)
        assert r.common_words >= 0.6 * r.item_words


def test_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 30))]
        assert decontaminate.common_words(a, b) == brute.lcs(a, b)


def test_answer_decides_between():
    words = [f"w{i}" for i in range(20)]
    item = decontaminate.read_item(1, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12 w13? w14 w15 w16 w17 w18 w19")
    assert item.answer == 14

    def codes(text):
        return decontaminate.codes_of([" ".join(text).encode()])[0].tolist()

    assert decontaminate.judge(item, codes(words)) == (20, True)
    assert decontaminate.judge(item, codes(words[7:])) == (13, True)  # 65 %, with the answer
    assert decontaminate.judge(item, codes(words[:13])) == (13, False)  # 65 %, without
    assert decontaminate.judge(item, codes(words[10:])) == (10, False)
    short = decontaminate.read_item(2, "to be or")
    assert decontaminate.judge(short, codes("not to be or not".split()))[1]
    assert not decontaminate.judge(short, codes("to x be x or".split()))[1]


def test_sketch_finds_the_leading_vectors(spark):
    """Against the eigenvectors of the whole matrix, on a matrix of known low rank."""
    rng = np.random.default_rng(2)
    basis, _ = np.linalg.qr(rng.standard_normal((300, 12)))
    matrix = (rng.standard_normal((500, 12)) * np.arange(12, 0, -1)) @ basis.T
    omega = decontaminate.random_matrix(300, 40).astype(np.float64)
    found = decontaminate._leading(matrix.T @ (matrix @ omega), omega, 12)
    assert np.allclose(np.linalg.svd(found.T @ basis)[1], 1, atol=1e-3)


def test_sparse_times_dense():
    rng = np.random.default_rng(9)
    dense = np.where(rng.random((30, 200)) < 0.3, rng.random((30, 200)), 0).astype(np.float32)
    dense[7] = 0
    row, column = np.nonzero(dense)
    matrix = rng.random((200, 9)).astype(np.float32)
    at, sums = decontaminate._times(row, column, dense[row, column], matrix)
    assert at.tolist() == [i for i in range(30) if i != 7]
    assert np.allclose(sums, (dense @ matrix)[at], rtol=1e-4)


def test_blocks_of_items(spark, monkeypatch):
    """Items that go through in several blocks are found as in one."""
    docs, bench = brute.documents(spark, brute.MIDDLE), spark.read.parquet(f"{brute.MIDDLE}/benchmark.parquet")
    key = ["doc_id", "item_id", "common_words"]
    whole = {tuple(r) for r in decontaminate.leaks(docs, bench).select(key).collect()}
    assert len(whole) > 10
    monkeypatch.setattr(decontaminate, "TERMS_PER_BLOCK", 400)
    parts = {tuple(r) for r in decontaminate.leaks(docs, bench).select(key).collect()}
    assert whole == parts
    clean = decontaminate.drop_leaks(docs, bench)
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()} == {d for d, _, _ in whole}


def test_decontaminate_odd_cases(spark):
    docs = brute.odd(spark)
    ddl = "item_id long, text string, doc_id long"
    bench = spark.createDataFrame([(1, None, 1), (2, "", 1), (None, "nobody's text", 1), (4, "!!", 1)], ddl)
    got = decontaminate.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} <= {(None, None)}
    clean = decontaminate.drop_leaks(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len(got)
    nothing = spark.createDataFrame([], ddl)
    assert decontaminate.leaks(docs, nothing).count() == 0
    assert decontaminate.drop_leaks(docs, nothing).count() == docs.count()
    assert decontaminate.leaks(brute.none(spark), bench).count() == 0


class Twin:
    def __init__(self, name):
        self.run, self.oracle = QUERIES[name], ORACLES[name]

    def __call__(self, spark, root):
        return self.run(spark, root)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert difference(spark, connect(brute.MIDDLE), Twin(name), brute.MIDDLE) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_every_query_runs(spark, name):
    assert QUERIES[name](spark, brute.SMALL).count() > 0


def words_of(text):
    folded = (text or "").lower().encode().translate(None, decontaminate.PUNCTUATION)
    return folded.split()


def test_pipeline(spark, tmp_path):
    """The stages one after another against plain versions of each, on the rows it got."""
    docs = brute.documents(spark, brute.MIDDLE)
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in now.collect()]
        now = stage(spark, now, brute.MIDDLE)
        now.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        assert now.columns == docs.columns
        kept = {r.doc_id for r in now.collect()}
        if name == "exact_dedup":
            first: dict[str, int] = {}
            for doc, text in sorted(before):
                first.setdefault(brute.squeezed(text), doc)
            assert kept == set(first.values())
        elif name == "simhash":
            assert kept == set(brute.components_of(before, 2).values())
        elif name == "quality":
            trees = quality.train(docs, spark.read.parquet(f"{brute.MIDDLE}/labels.parquet"))
            rows = [list(brute.statistics((text or "").encode()).values()) for _, text in before]
            scores = trees.score(np.array(rows))
            assert 0 < len(kept) < len(before)
            assert kept == {doc for (doc, _), score in zip(before, scores) if score >= quality.REJECT_BELOW}
        else:
            items = [words_of(r.text) for r in spark.read.parquet(f"{brute.MIDDLE}/benchmark.parquet").collect()]
            share = {doc: brute.largest_share(items, words_of(text), decontaminate.common_words) for doc, text in before}
            leaks, clean = ({d for d, x in share.items() if f(x)} for f in (lambda x: x >= 0.8, lambda x: x < 0.5))
            assert leaks and not kept & leaks and clean <= kept
    end = corpus_pipeline.run(spark, brute.MIDDLE).collect()
    assert {r.doc_id for r in end} == kept
    assert sum(r.length for r in end) == sum({r.doc_id: r.doc_tokens for r in end}.values())


def test_pipeline_with_odd_tables(spark, tmp_path):
    root = str(tmp_path)
    brute.odd(spark).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    got = corpus_pipeline.run(spark, root).collect()
    assert {r.doc_id for r in got} >= {1, 3, 8, 9, None}
    empty = str(tmp_path / "empty")
    brute.none(spark).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{empty}/labels.parquet")
    spark.createDataFrame([(1, "a b")], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


@pytest.mark.parametrize("items", [1, 60])
def test_an_item_in_a_third_of_all_documents(spark, items):
    """Its words are then common in the corpus; it is found in every one all the same."""
    rng = random.Random(items)
    bench = [" ".join(f"q{rng.randrange(5000)}" for _ in range(rng.choice([9, 14, 40]))) for _ in range(items)]
    rows = []
    for doc in range(300):
        own = [f"v{rng.randrange(3000)}" if rng.random() < 0.6 else "the" for _ in range(200)]
        at = rng.randrange(200)
        rows.append((doc, " ".join(own[:at] + (bench[0].split() if doc % 3 == 0 else []) + own[at:])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    table = spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, table).collect()}
    assert got == {(doc, 0) for doc in range(0, 300, 3)}


def zipf(rng, size):
    return [f"z{min(int(rng.paretovariate(0.6)), 12000)}" for _ in range(size)]


def test_many_items_of_few_words(spark):
    """1,500 items within one block's vocabulary: verbatim and paraphrased copies are found."""
    rng = random.Random(15)
    items = [zipf(rng, rng.randrange(15, 60)) for _ in range(1500)]
    assert len({w for item in items for w in item}) < decontaminate.TERMS_PER_BLOCK
    texts, held = [], []
    for doc in range(150):
        own, nth = zipf(rng, 300), rng.randrange(len(items))
        part = list(items[nth])
        if doc % 2:  # a tenth of the words replaced
            for i in rng.sample(range(len(part)), len(part) // 10):
                part[i] = f"n{rng.randrange(999)}"
        at = rng.randrange(len(own))
        texts.append(" ".join(own[:at] + part + own[at:]))
        held.append((doc, nth))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    bench = spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()}
    assert set(held[::2]) <= got
    assert len(set(held[1::2]) & got) >= 0.9 * len(held[1::2])


def test_the_basis_keeps_every_query():
    """Rows that the leading vectors do not have are added to them."""
    rng = np.random.default_rng(4)
    dense = np.where(rng.random((90, 400)) < 0.05, rng.random((90, 400)), 0).astype(np.float32)
    dense[:, 0] += 0.1
    dense[7] = dense[8]
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    row, column = np.nonzero(dense)
    start = np.linalg.svd(dense)[2][:20].T.astype(np.float32)
    basis, queries = decontaminate._completed(start, row, column, dense[row, column], 90)
    assert np.allclose(basis.T @ basis, np.eye(basis.shape[1]), atol=1e-3)
    assert (queries**2).sum(axis=1).min() >= decontaminate.KEPT
    assert np.allclose(queries, dense @ basis, atol=1e-4)


def test_short_items_in_long_documents(spark):
    """Items of 1 to 11 words, rare and common ones, against a search at every place."""
    rng = random.Random(12)
    items = [[w + "s" * (n % 2) for w in zipf(rng, size)] for size in range(1, 12) for n in range(8)]
    texts = []
    for doc in range(240):
        own, at = zipf(rng, 400), rng.randrange(401)
        part = items[doc % len(items)] if doc % 3 else items[doc % len(items)][:-1]
        texts.append(own[:at] + part + own[at:])
    docs = spark.createDataFrame([(n, " ".join(t)) for n, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(n, " ".join(i)) for n, i in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs.repartition(4), bench).collect()}
    whole = {
        (doc, nth)
        for doc, text in enumerate(texts)
        for nth, item in enumerate(items)
        if any(text[i : i + len(item)] == item for i in range(len(text)))
    }
    assert len(whole) > 160 and whole <= got
    assert all(len(items[nth]) >= decontaminate.FEW for _, nth in got - whole)
