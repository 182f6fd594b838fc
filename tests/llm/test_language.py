"""Language by compression against a plain version and held-out accuracy."""

import zlib

import numpy as np
import pytest
import zstandard

from brute import MIDDLE, documents, none, odd, pairs_of
from tidemill.llm import language_id as L


@pytest.fixture(scope="module")
def learned(spark):
    return L.train(documents(spark, MIDDLE))


def plain_prediction(learned, text):
    """The language by whole loops: every piece, every dictionary, no shared compressor."""
    low = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in (text or "").lower())
    if not any(c.isalpha() for c in text or ""):
        return "und"
    raw = " ".join(low.split(" ")).encode()
    raw = b" ".join(part for part in raw.split() if part)
    best = None
    for name, words in zip(learned.names, learned.dictionaries):
        known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=L.LEVEL)
        size = 0
        for at in range(0, len(raw), L.PIECE):
            maker = zstandard.ZstdCompressor(
                level=L.LEVEL, dict_data=known, write_content_size=False,
                write_checksum=False, write_dict_id=False,
            )
            size += len(maker.compress(raw[at : at + L.PIECE]))
        if best is None or size < best[0]:
            best = (size, name)
    return best[1]


def test_held_out_languages_are_found_and_equal_the_plain_version(spark, learned):
    docs = documents(spark, MIDDLE)
    rows = {r["doc_id"]: r for r in docs.collect()}
    found = L.identified(docs).collect()
    assert len(found) == len(rows)
    held = [r for r in found if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert {r["doc_id"] for r in found if r["held_out"]} == {r["doc_id"] for r in held}
    right = sum(r["lang_pred"] == rows[r["doc_id"]]["lang"] for r in held)
    assert right >= 0.98 * len(held)
    accepted = [r for r in held if r["accepted"]]
    assert len(accepted) >= 0.95 * len(held)
    wrong = sum(r["lang_pred"] != rows[r["doc_id"]]["lang"] for r in accepted)
    assert wrong <= 0.005 * len(accepted)
    for r in found[::17]:
        assert r["lang_pred"] == plain_prediction(learned, rows[r["doc_id"]]["text"])
        assert 0 <= r["score"] <= 1


def test_nothing_is_learned_from_the_held_out_rows_or_other_columns(spark, learned):
    rows = documents(spark, MIDDLE).collect()
    swapped = [
        (r["doc_id"], r["text"], "xx" if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 else r["lang"])
        for r in rows
    ]
    again = L.train(spark.createDataFrame(swapped, "doc_id long, text string, lang string"))
    assert again == learned


def test_dictionaries_are_bounded_and_rare_words_come_first(learned):
    assert sorted(learned.names) == ["de", "en", "es", "fr"]
    assert all(0 < len(d) <= L.DICTIONARY for d in learned.dictionaries)
    assert b"the " in learned.dictionaries[learned.names.index("en")][-200:]


def test_narrow_margins_are_rejected(spark):
    """A text of no language is one that all dictionaries miss alike."""
    docs = documents(spark, MIDDLE).select("doc_id", "text", "lang")
    strange = spark.createDataFrame(
        [(900_001, "xqzkvw jjqxx wqkz", None), (900_002, "and the other of them, with that of the others in their hands", None)], docs.schema
    )
    found = {
        r["doc_id"]: r for r in L.identified(docs.union(strange), reject=True).where("doc_id > 900000").collect()
    }
    assert found[900_001]["lang_pred"] == "und" and not found[900_001]["accepted"]
    assert found[900_002]["lang_pred"] == "en" and found[900_002]["accepted"]
    best, score, margin = L.decide(np.array([100, 90, 90]))
    assert (best, margin) == (1, 0.0) and 0 < score < 0.5


def test_odd_rows_and_empty_tables(spark):
    rows = odd(spark)
    found = L.identified(rows).collect()
    assert len(found) == rows.count()
    by_text = {r["doc_id"]: r for r in found if r["doc_id"] is not None}
    assert by_text[3]["lang_pred"] == by_text[4]["lang_pred"] == by_text[6]["lang_pred"] == "und"
    assert by_text[3]["score"] == 0.0
    assert by_text[9]["lang_pred"] == by_text[10]["lang_pred"] == "en"
    assert all(not r["held_out"] for r in found if r["doc_id"] is None)
    assert sum(t is None for _, t in pairs_of(rows)) < sum(r["lang_pred"] == "und" for r in found)
    assert L.identified(none(spark)).collect() == []
    unlabelled = rows.withColumn("lang", rows["lang"].substr(9, 1)).replace("", None, ["lang"])
    assert {r["lang_pred"] for r in L.identified(unlabelled).collect()} == {"und"}


def test_one_doc_id_with_very_many_rows_is_a_bounded_sample(spark):
    doc = next(n for n in range(9) if zlib.crc32(str(n).encode()) % 3 != 1)
    name = str.maketrans("0123456789", "abcdefghij")
    rows = [(doc, f"{n}w is text".translate(name), "en") for n in range(3000)]
    learned = L.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 10)
    assert learned.dictionaries[0].count(b" ") == 12
