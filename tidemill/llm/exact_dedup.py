"""Exact duplicates by content-defined chunk recipes.

Each text, white space normalised, is cut where a rolling hash of its last bytes says so, so
equal texts are cut alike wherever they lie. Distinct chunks are moved once, each under its
hash; a hash that turns out to stand for two different chunks is replaced by identifiers made
from the chunks themselves. A document is then the ordered list of its chunk identifiers, and
only these short lists are grouped and compared.

Defined results: null text is empty; all empty texts are one group; a null doc_id comes after
every other when the row that stays is chosen; of repeated rows (same doc_id, same text) one
stays; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import BLANKS, batch_of, keep_rows, raw_text
from tidemill.session import materialize

WINDOW = 16
MEAN_BITS = 9  # a cut every 512 bytes or so
LEAST, MOST = 128, 4096
GEAR = np.random.default_rng(20_261).integers(0, 2**32, 256, dtype=np.uint32)


def squeeze(raw: bytes) -> bytes:
    """Every run of white space as one space, at both ends too."""
    words = b" ".join(raw.split())
    if not words:
        return b" " if raw else b""
    head = b" " if raw[0] in BLANKS else b""
    tail = b" " if raw[-1] in BLANKS else b""
    return head + words + tail if head or tail else words


def cuts(text: bytes) -> list[int]:
    """The ends of the chunks; the last is the length of the text, an empty text has none."""
    size = len(text)
    if size <= LEAST:
        return [size] if size else []
    h = GEAR[np.frombuffer(text, dtype=np.uint8)]
    span = 1
    while span < WINDOW:  # h[i] sums the last 2 * span bytes, each shifted by its distance
        h[span:] = h[span:] + (h[:-span] << np.uint32(span))
        span *= 2
    # the low bits depend on the newest bytes only; bits from WINDOW on see all of them
    marks = np.flatnonzero((h >> np.uint32(32 - MEAN_BITS)) == 0) + 1
    ends, start = [], 0
    for mark in marks.tolist() + [size]:
        while mark - start > MOST:
            start += MOST
            ends.append(start)
        if mark - start >= LEAST or (mark == size and mark > start):
            ends.append(mark)
            start = mark
    return ends


def chunks_of(text: bytes) -> list[bytes]:
    ends = cuts(text)
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def chunk_hash(chunk: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(chunk, 7) >> (64 - bits)


RECIPE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_sha256", pa.string()),
        ("n_bytes", pa.int64()),
        ("n_chunks", pa.int32()),
        ("recipe", pa.binary()),
    ]
)
CHUNK = pa.schema([("hash", pa.binary()), ("chunk", pa.binary())])


def _recipes(bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f.name: [] for f in RECIPE}
            for doc, raw in zip(batch["doc_id"].to_pylist(), batch["raw"].to_pylist()):
                text = squeeze(raw)
                parts = chunks_of(text)
                out["doc_id"].append(doc)
                out["text_sha256"].append(hashlib.sha256(text).hexdigest())
                out["n_bytes"].append(len(text))
                out["n_chunks"].append(len(parts))
                out["recipe"].append(
                    b"".join(chunk_hash(p, bits).to_bytes(8, "big") for p in parts)
                )
            yield batch_of(RECIPE, out)

    return task


def _chunks(bits: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, bytes] = {}
            extra: list[tuple[bytes, bytes]] = []
            for raw in batch["raw"].to_pylist():
                for part in chunks_of(squeeze(raw)):
                    name = chunk_hash(part, bits).to_bytes(8, "big")
                    if found.setdefault(name, part) != part:
                        extra.append((name, part))
            rows = [*found.items(), *extra]
            yield batch_of(CHUNK, {"hash": [r[0] for r in rows], "chunk": [r[1] for r in rows]})

    return task


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Per row of ``docs``: its digest and the ordered list of its chunks' verified
    identifiers (8 bytes each, 40 where a hash was not enough), written once."""
    rows = raw_text(docs)
    lists = materialize(
        rows.mapInArrow(_recipes(bits), _ddl(RECIPE)).withColumn(
            "row_no", F.monotonically_increasing_id()
        ),
        "recipes",
    )
    # distinct chunks move once, then a hash with two different chunks is not an identifier
    distinct = rows.mapInArrow(_chunks(bits), _ddl(CHUNK)).distinct()
    clash = materialize(
        distinct.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"),
        "clashes",
    )
    if clash.isEmpty():
        return lists
    return _renamed(lists, rows, clash, bits)


def _renamed(lists: DataFrame, rows: DataFrame, clash: DataFrame, bits: int) -> DataFrame:
    """Recipes in which every chunk under a clashing hash carries its own SHA-256 as well.
    Rows with the same doc_id are told apart by their text."""
    parts = (
        rows.mapInArrow(
            _parts(bits), "doc_id long, text_sha256 string, pos int, hash binary, name binary"
        )
        .distinct()
        .join(clash.withColumn("clashes", F.lit(True)), "hash", "left")
        .withColumn("id", F.when(F.col("clashes"), F.concat("hash", "name")).otherwise(F.col("hash")))
    )
    told = parts.groupBy("doc_id", "text_sha256").agg(
        F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("ids")
    )
    told = told.select(
        F.col("doc_id").alias("d"),
        F.col("text_sha256").alias("s"),
        F.expr("unhex(array_join(transform(ids, x -> hex(x.id)), ''))").alias("verified"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_sha256") == F.col("s"))
    return materialize(
        lists.join(told, same, "left")
        .withColumn("recipe", F.coalesce("verified", "recipe"))
        .drop("verified", "d", "s"),
        "recipes",
    )


def _parts(bits: int):
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_sha256", pa.string()),
            ("pos", pa.int32()),
            ("hash", pa.binary()),
            ("name", pa.binary()),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f.name: [] for f in schema}
            for doc, raw in zip(batch["doc_id"].to_pylist(), batch["raw"].to_pylist()):
                text = squeeze(raw)
                sha = hashlib.sha256(text).hexdigest()
                for pos, part in enumerate(chunks_of(text)):
                    out["doc_id"].append(doc)
                    out["text_sha256"].append(sha)
                    out["pos"].append(pos)
                    out["hash"].append(chunk_hash(part, bits).to_bytes(8, "big"))
                    out["name"].append(hashlib.sha256(part).digest())
            yield batch_of(schema, out)

    return task


def exact_groups(docs: DataFrame, bits: int = 64) -> DataFrame:
    """Per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    lists = recipes(docs, bits)
    # nulls sort last: (is null, doc_id, row)
    first = F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "row_no")
    # a lone row needs no group; the others' groups are written, so that the join below has a
    # plain shuffle on both sides and Spark can split the partition of a very large group
    groups = materialize(
        lists.groupBy("n_bytes", "recipe")
        .agg(F.count("*").alias("n"), F.min(first).alias("first"))
        .where("n > 1"),
        "groups",
    )
    own = F.col("first").isNull()
    return lists.join(groups, ["n_bytes", "recipe"], "left").select(
        "doc_id",
        F.when(own, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (own | (F.col("row_no") == F.col("first.row_no"))).alias("kept"),
        "text_sha256",
    )


def squeezed_sha256(text: Column) -> Column:
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.sha2(flat, 256)


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""
    kept = exact_groups(docs).where("kept").select("doc_id", F.col("text_sha256").alias("tag"))
    return keep_rows(docs, kept, squeezed_sha256(F.col("text")))


def _ddl(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)
