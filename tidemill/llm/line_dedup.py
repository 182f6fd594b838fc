"""Lines that stand on many sites, found by HyperLogLog sketches, and their removal.

A line is what stands between two newlines; lines are equal if they are the same byte for byte,
and an empty line is never boilerplate. Every line's hash gets a sketch of its distinct sites;
sketches merge by aggregation, so a line that stands in a third of all documents costs a sketch
per task. Where the estimate is so near the threshold that its error could matter, the line's
distinct sites are counted exactly. Only the hashes of boilerplate lines meet the documents.

Defined results: null text is empty, which is one empty line; a null source is a site of its
own; rows with one doc_id are told apart by their text, rows repeated as a whole get one result
each; a text all of whose lines go is empty; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import raw_text, row_key
from tidemill.session import materialize

SITES = 10  # a line on so many sites is boilerplate
SKETCH_BITS = 12  # 2 ** 12 registers: a relative error of 1.04 / 64
ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)
SPREAD = 4  # errors that count as near
NO_SITE = "\x00"  # the site of rows without one


def text_lines(docs: DataFrame) -> DataFrame:
    """``row, site, pos, line, chars``: the hash and length of every line that is not empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        row_key(F.col("doc_id"), F.xxhash64(text.cast("binary"))).alias("row"),
        F.coalesce(F.col("source").cast("string"), F.lit(NO_SITE)).alias("site"),
        F.posexplode(F.split(text, "\n")).alias("pos", "part"),
    )
    return rows.where("part <> ''").select(
        "row", "site", "pos", F.xxhash64("part").alias("line"), F.length("part").alias("chars")
    )


def boilerplate(lines: DataFrame, sites: int = SITES) -> DataFrame:
    """``line, chars`` of the lines that stand on at least ``sites`` distinct sites."""
    spread = materialize(
        lines.groupBy("line", "chars")
        .agg(F.hll_sketch_agg("site", SKETCH_BITS).alias("sketch"))
        .select("line", "chars", F.hll_sketch_estimate("sketch").alias("about"))
        .where(F.col("about") >= sites * (1 - SPREAD * ERROR) - 1),
        "spread",
    )
    near = F.col("about") <= sites * (1 + SPREAD * ERROR) + 1
    exact = (
        lines.select("line", "chars", "site")
        .join(spread.where(near), ["line", "chars"], "left_semi")
        .distinct()
        .groupBy("line", "chars")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= sites)
    )
    far = spread.where(~near).select("line", "chars")
    return materialize(exact.select("line", "chars").union(far), "boilerplate")


def _rebuild(texts: bool):
    last = "kept_text" if texts else "kept_sha256"
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_lines", pa.int64()),
            ("n_removed", pa.int64()),
            (last, pa.string()),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, result = [], [], []
            for raw, places in zip(batch["raw"].to_pylist(), batch["places"].to_pylist()):
                lines, drop = raw.split(b"\n"), set(places or ())
                text = b"\n".join(line for nth, line in enumerate(lines) if nth not in drop)
                total.append(len(lines))
                gone.append(len(drop))
                result.append(text.decode() if texts else hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(total, pa.int64()),
                    pa.array(gone, pa.int64()),
                    pa.array(result, pa.string()),
                ],
                schema=schema,
            )

    return task


def drop_boilerplate(docs: DataFrame, sites: int = SITES, texts: bool = True) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_lines, n_removed`` and ``kept_text``, the other lines
    joined by newlines, or only their hash ``kept_sha256``."""
    lines = text_lines(docs)
    known = boilerplate(lines, sites)
    places = (
        lines.select("row", "pos", "line", "chars")
        .join(known, ["line", "chars"], "left_semi")
        .groupBy("row")
        .agg(F.collect_set("pos").alias("places"))  # of one document
    )
    rows = raw_text(docs).withColumn("row", row_key(F.col("doc_id"), F.xxhash64("raw")))
    last = "kept_text" if texts else "kept_sha256"
    return (
        rows.join(places, "row", "left")
        .select("doc_id", "raw", "places")
        .mapInArrow(_rebuild(texts), f"doc_id long, n_lines long, n_removed long, {last} string")
    )
