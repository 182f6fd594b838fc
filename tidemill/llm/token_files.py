"""Token ids of a corpus as files in ascending doc_id order, and back.

Texts are range-partitioned by doc_id, so every task encodes one stretch of the order and no
task sees more. It writes blocks of whole documents, about ``BLOCK_IDS`` ids each, as rows: the
stretch and the number of the block, its documents with their lengths, and the ids in the
format of ``simple8b``. The rows go through Spark's Parquet writer, so a task that is repeated
after a lost executor replaces its output, any store that Spark writes to will do, and a reader
finds a document's block by the files' statistics. Reading needs nothing but a block's row.

Defined results: null text is empty and has the end id alone; a null doc_id comes first; rows
with one doc_id follow each other by the hash of their text, over several files if they are many; a text longer than a block is a
block of its own; an empty table writes no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm import simple8b
from tidemill.llm.common import raw_text, text_groups
from tidemill.llm.tokens import WORDS_KEPT, default_tokenizer, encoder
from tidemill.session import work_path

BLOCK_IDS = 1 << 17

BLOCK = pa.schema(
    [
        ("stretch", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),  # ids of the stretch before this block
        ("n_ids", pa.int64()),
        ("first_doc", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
BLOCK_DDL = (
    "stretch int, block int, first_id long, n_ids long, first_doc long,"
    " doc_ids array<long>, lengths array<long>, payload binary"
)
DIGEST = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("stretch", pa.int32()),
        ("within", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def _write(tokenizer: str, end: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, block, first = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        held: list[np.ndarray] = []
        size = 0

        def row() -> pa.RecordBatch:
            lengths = [len(ids) for ids in held]
            values = [stretch, block, first, size, docs[0], docs, lengths]
            values.append(simple8b.encode(np.concatenate(held)))
            return pa.RecordBatch.from_arrays(
                [pa.array([v], type=f.type) for v, f in zip(values, BLOCK)], schema=BLOCK
            )

        with encoder(tokenizer, WORDS_KEPT) as words:
            for names, texts in text_groups(batches, "doc_id"):
                ids, bounds = words.encode(texts, end)
                for nth, (name,) in enumerate(names):
                    part = ids[bounds[nth] : bounds[nth + 1]]
                    docs.append(name)
                    held.append(part)
                    size += len(part)
                    if size >= BLOCK_IDS:
                        yield row()
                        block, first = block + 1, first + size
                        docs, held, size = [], [], 0
        if docs:
            yield row()

    return task


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            data = simple8b.decode(row["payload"]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            starts = ends - row["lengths"]
            sums = [zlib.crc32(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array([row["stretch"]] * len(sums), pa.int32()),
                    pa.array(starts + row["first_id"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                schema=DIGEST,
            )


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = 2) -> None:
    """Encode every text and write the blocks under ``path``."""
    order = ["doc_id", "hash"]  # the hash parts rows that share a doc_id, or have none
    ordered = (
        raw_text(docs)
        .withColumn("hash", F.xxhash64("raw"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("hash")
    )
    blocks = ordered.mapInArrow(_write(tokenizer or default_tokenizer(), end), BLOCK_DDL)
    blocks.write.option("compression", "zstd").parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    blocks = spark.read.schema(BLOCK_DDL).parquet(path)
    totals = blocks.groupBy("stretch").agg(F.sum("n_ids").alias("n"))  # one row per task
    before = F.sum("n").over(Window.orderBy("stretch")) - F.col("n")
    starts = totals.select("stretch", before.alias("before"))
    digests = blocks.mapInArrow(
        _read, "doc_id long, stretch int, within long, n_tokens long, ids_crc32 long"
    )
    return digests.join(starts, "stretch").select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenized(docs: DataFrame, tokenizer: str | None = None, end: int = 2) -> DataFrame:
    spark = docs.sparkSession
    path = work_path(spark, "tokens")
    write_tokens(docs, path, tokenizer, end)
    return read_tokens(spark, path)
