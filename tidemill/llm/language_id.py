"""Language of a text by compression: the language whose dictionary makes it smallest.

Each language has a raw-content zstandard dictionary of its most frequent words, the rarest
first, since zstandard spells near matches shorter. A text is lowered and stripped to its
letters, cut into pieces of ``PIECE`` bytes, so that a long text cannot become its own
dictionary, and every piece of it is compressed with every dictionary. The smallest sum
wins; of equal sums the language with more rows to learn from. ``accepted`` is false
where the second language is less than ``MARGIN`` of the sum away: ``identified(..., reject=True)``
calls such texts ``und``. Scores cover every row in one pass without a shuffle.

Dictionaries are fitted on a bounded sample: of each of the ``LANGUAGES`` languages with the
most rows the ``SAMPLE`` documents with the smallest hash of their doc_id, never a held-out one.

Defined results: null text and text without a letter are ``und`` with score 0; rows with a null
doc_id are predicted, not held out and not learned from; rows with a null lang are not learned
from; repeated rows are predicted each, and are one row of the sample; without anything to learn
from all is ``und``; with one language all texts with a letter are of it; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import ready, text_groups

FOLDS, HELD_OUT = 3, 1
LANGUAGES = 256  # languages that are learned at most
SAMPLE = 400  # documents of a language that its dictionary is made from at most
SPARE = 8
DICTIONARY = 1 << 14  # bytes of a dictionary at most
WORD = 40  # bytes of a word in a dictionary at most
PIECE = 1 << 12
LEVEL = 6
MARGIN = 0.01
SOFT = 4.0  # bytes of difference that make one language e times likelier than another
UNKNOWN = "und"

# every ASCII byte that is no letter parts words; bytes beyond ASCII are parts of letters
_ASCII_LETTERS = bytes(range(97, 123)) + bytes(range(65, 91))
_PARTS = bytes(c if c > 127 or 97 <= c <= 122 else 32 for c in range(256))


def letters(text: str) -> bytes:
    """The words of a text in lower letters, one space between them; empty without a letter."""
    if text.encode().translate(None, _ASCII_LETTERS) == text.encode():
        if not any(c.isalpha() for c in text):
            return b""
    return b" ".join(text.lower().encode().translate(_PARTS).split())


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


@dataclass(frozen=True)
class Languages:
    """Names in the order that settles ties, and the dictionary of each."""

    names: list[str]
    dictionaries: list[bytes]

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        made = []
        for words in self.dictionaries:
            known = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(level=LEVEL)
            made.append(
                zstandard.ZstdCompressor(
                    level=LEVEL,
                    dict_data=known,
                    write_content_size=False,
                    write_checksum=False,
                    write_dict_id=False,
                )
            )
        return made


def sizes(compressors: list[zstandard.ZstdCompressor], text: bytes) -> np.ndarray:
    """Bytes of the whole text under each dictionary."""
    pieces = [text[at : at + PIECE] for at in range(0, len(text), PIECE)]
    return np.array([sum(len(c.compress(p)) for p in pieces) for c in compressors], dtype=np.int64)


def decide(found: np.ndarray) -> tuple[int, float, float]:
    """The number of the smallest, its score, and how far off the second is as a share."""
    best = int(found.argmin())
    score = float(1 / np.exp((found[best] - found) / SOFT).sum())
    others = np.delete(found, best)
    margin = float((others.min() - found[best]) / found[best]) if len(others) else 1.0
    return best, score, margin


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, texts in text_groups(batches, "lang", text="text"):
        counts: Counter = Counter()
        for (lang,), text in zip(rows, texts):
            counts.update((lang, w) for w in letters(text).split() if len(w) <= WORD)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang for lang, _ in counts], pa.string()),
                pa.array([word for _, word in counts], pa.binary()),
                pa.array(list(counts.values()), pa.int64()),
            ],
            names=["lang", "word", "n"],
        )


def train(docs: DataFrame, sample: int = SAMPLE) -> Languages:
    """Dictionaries of the words of at most ``sample`` documents a language."""
    ready(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), "text"
    ).where("doc_id is not null and lang is not null and text is not null")
    rows = rows.where(~held_out(F.col("doc_id")))
    common = [
        (r["lang"], r["docs"])
        for r in rows.groupBy("lang")
        .agg(F.count("*").alias("n"), F.approx_count_distinct("doc_id").alias("docs"))
        .orderBy(F.desc("n"), "lang")
        .limit(LANGUAGES)
        .collect()
    ]
    if not common:
        return Languages([], [])
    # the smallest hashes of a language are below this share of all hashes, SPARE times as many
    # as needed on average, so that few rows of a large language meet in its window
    most = [F.lit(x) for lang, docs in common for x in (lang, min(1.0, SPARE * sample / docs))]
    share = F.element_at(F.create_map(*most), F.col("lang"))
    by_hash = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = (
        rows.where(F.col("lang").isin([lang for lang, _ in common]))
        .select("lang", "doc_id", F.xxhash64("doc_id").alias("hash"))
        .where(F.shiftrightunsigned("hash", 11) < share * 2.0**53)
        .distinct()
        .withColumn("nth", F.row_number().over(by_hash))
        .where(F.col("nth") <= sample)
        .select("lang", "doc_id")
    )
    # a doc_id may have many rows: of those, too, the smallest hashes
    by_text = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), F.xxhash64("text"), "text")
    texts = (
        rows.join(F.broadcast(chosen), ["lang", "doc_id"])  # LANGUAGES * sample rows at most
        .select("lang", "doc_id", "text")
        .distinct()
        .withColumn("nth", F.row_number().over(by_text))
        .where(F.col("nth") <= sample)
        .select("lang", "text")
    )
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    size = F.sum(F.length("word") + 1).over(frequent.rowsBetween(Window.unboundedPreceding, 0))
    words = (
        texts.mapInArrow(_count_words, "lang string, word binary, n long")
        .groupBy("lang", "word")
        .agg(F.sum("n").alias("n"))
        .withColumn("size", size)
        .where(F.col("size") <= DICTIONARY)
    )
    kept: dict[str, list] = {}
    for row in words.collect():  # LANGUAGES * DICTIONARY bytes at most
        kept.setdefault(row["lang"], []).append((row["size"], bytes(row["word"])))
    names = [lang for lang, _ in common if lang in kept]
    ordered = [sorted(kept[lang], reverse=True) for lang in names]
    return Languages(names, [b" ".join([*(w for _, w in words), b""]) for words in ordered])


FOUND_DDL = "doc_id long, lang_pred string, score double, margin double"


def _identify(languages: Languages):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = languages.compressors()
        for batch in batches:
            names, scores, margins = [], [], []
            for text in batch["text"].to_pylist():
                plain = letters(text) if text and compressors else b""
                if plain:
                    best, score, margin = decide(sizes(compressors, plain))
                    names.append(languages.names[best])
                else:
                    score = margin = 0.0
                    names.append(UNKNOWN)
                scores.append(score)
                margins.append(margin)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(margins, pa.float64()),
                ],
                names=["doc_id", "lang_pred", "score", "margin"],
            )

    return task


def identified(
    docs: DataFrame, sample: int = SAMPLE, margin: float = MARGIN, reject: bool = False
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, lang_pred, score, margin, accepted``. With
    ``reject``, texts that are not accepted are ``und``."""
    languages = train(docs, sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = texts.mapInArrow(_identify(languages), FOUND_DDL).withColumn(
        "accepted", (F.col("lang_pred") != UNKNOWN) & (F.col("margin") >= margin)
    )
    if reject:
        found = found.withColumn("lang_pred", F.when(F.col("accepted"), F.col("lang_pred")).otherwise(UNKNOWN))
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "margin", "accepted"
    )
