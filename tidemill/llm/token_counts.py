"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A change is an insert (counts after), a delete (counts before) or a revision (both); signed, it
is a row to add to the totals. A batch of changes is added up by source, language and tokenizer
before anything is shuffled and written under its own number, so committing a batch again, after
a failure or by mistake, replaces what it wrote and never adds twice. Totals are the sum of the
committed batches; ``compact`` folds what is committed into one base and writes down which batches
that holds, so a batch that arrives after later ones were folded still counts.

Two versions of tokenizers are patterns, counted by columns in the JVM; the third is a file of the
tokenizers library, given as a path.

Defined results: null text is empty and counts as a document without tokens; null source or
language is a group of its own; repeated rows count each; a group whose documents add up to
none is left out; an empty batch commits nothing and empties what it wrote before; an empty table
has no totals; other columns are ignored. ``corpus_totals`` keeps one row of equal texts: the
smallest doc_id, then source and language; null is the last of each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.llm.common import raw_text, ready, text_groups
from tidemill.llm.tokens import default_tokenizer, encoder
from tidemill.session import materialize, work_path

GROUP = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens", "bytes"]
DELTA_DDL = (
    "source string, lang string, tokenizer string, documents long, tokens long, bytes long"
)
# versions of tokenizers that are plain patterns: a token is a match
WORDS = r"[^\x20\x09-\x0D]+"
PIECES = r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]"
NOISE = r"[#$%&*|]+"
LIBRARY = "word_bpe_49k"


def pattern_counter(pattern: str) -> Callable[[Column], Column]:
    return lambda text: F.regexp_count(text, F.lit(pattern)).cast("long")


COUNTERS = {"words-1": pattern_counter(WORDS), "pieces-1": pattern_counter(PIECES)}


def counted(docs: DataFrame, text: Column, counters=COUNTERS) -> DataFrame:
    """Per row and pattern: ``doc_id, source, lang, tokenizer, tokens, bytes``."""
    text = F.coalesce(text, F.lit(""))
    kinds = [
        F.struct(F.lit(name).alias("tokenizer"), count(F.col("whole")).alias("tokens"))
        for name, count in counters.items()
    ]
    return (
        docs.select("doc_id", "source", "lang", text.alias("whole"))
        .withColumn("bytes", F.octet_length("whole").cast("long"))
        .select("doc_id", "source", "lang", "bytes", F.explode(F.array(*kinds)).alias("kind"))
        .select("doc_id", "source", "lang", "kind.tokenizer", "kind.tokens", "bytes")
    )


def _library(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as words:
            for docs, texts in text_groups(batches, "doc_id"):
                _, bounds = words.encode(texts, 0)
                counts = bounds[1:] - bounds[:-1] - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for (d,) in docs], pa.int64()), pa.array(counts, pa.int64())],
                    names=["doc_id", "tokens"],
                )

    return task


def library_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, tokens`` by a tokenizer file of the tokenizers library."""
    return raw_text(docs).mapInArrow(_library(path or default_tokenizer()), "doc_id long, tokens long")


def _library_pairs(path: str):
    """Adds what the library counts in ``raw`` and in ``clean``; a null ``clean`` is equal to
    ``raw`` and costs nothing."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as words:
            for batch in batches:
                before = _counts(words, batch["raw"])
                after = before.copy()
                other = np.flatnonzero(batch["clean"].is_valid().to_numpy(zero_copy_only=False))
                after[other] = _counts(words, batch["clean"].take(pa.array(other)))
                rest = [n for n in batch.schema.names if n not in ("raw", "clean")]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[n] for n in rest), pa.array(before), pa.array(after)],
                    names=[*rest, "library_before", "library_after"],
                )

    return task


def _counts(words, texts: pa.Array) -> np.ndarray:
    out = [np.zeros(0, dtype=np.int64)]
    whole = pa.RecordBatch.from_arrays([texts], names=["raw"])
    for _, group in text_groups(iter([whole]), "raw"):
        _, bounds = words.encode(group, 0)
        out.append(bounds[1:] - bounds[:-1] - 1)
    return np.concatenate(out)


def revised(docs: DataFrame, path: str | None, name: str, counters=COUNTERS) -> DataFrame:
    """Per row its group, the hash of its text without noise, and per version of a tokenizer the
    counts before and after the noise goes: ``doc_id, source, lang, sha, kinds``."""
    ready(docs.sparkSession)
    whole = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", whole.alias("whole")
    ).withColumn("clean", F.regexp_replace("whole", NOISE, ""))
    same = F.col("clean") == F.col("whole")
    columns = {}
    for n, count in enumerate(counters.values()):
        columns[f"before{n}"] = count(F.col("whole"))
        columns[f"after{n}"] = F.when(same, F.col(f"before{n}")).otherwise(count(F.col("clean")))
    rows = rows.withColumns({k: c for k, c in columns.items() if k.startswith("before")})
    rows = rows.withColumns({k: c for k, c in columns.items() if k.startswith("after")})
    rows = rows.select(
        "doc_id",
        "source",
        "lang",
        F.unhex(F.sha2("clean", 256)).alias("sha"),
        F.octet_length("whole").cast("long").alias("bytes_before"),
        F.octet_length("clean").cast("long").alias("bytes_after"),
        *columns,
        F.col("whole").cast("binary").alias("raw"),
        F.when(~same, F.col("clean").cast("binary")).alias("clean"),
    )
    if path:
        kept = [f for f in rows.schema.fields if f.name not in ("raw", "clean")]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
        schema += ", library_before long, library_after long"
        rows = rows.mapInArrow(_library_pairs(path), schema)
    names = {n: (f"before{i}", f"after{i}") for i, n in enumerate(counters)}
    if path:
        names[name] = ("library_before", "library_after")
    kinds = [
        F.struct(F.lit(n).alias("tokenizer"), F.col(b).alias("before"), F.col(a).alias("after"))
        for n, (b, a) in names.items()
    ]
    return rows.select(
        "doc_id", "source", "lang", "sha", "bytes_before", "bytes_after", F.array(*kinds).alias("kinds")
    )


def _side(rows: DataFrame, side: str) -> DataFrame:
    kind = F.explode("kinds").alias("kind")
    return rows.select("source", "lang", F.col(f"bytes_{side}").alias("bytes"), kind).select(
        "source", "lang", "kind.tokenizer", F.col(f"kind.{side}").alias("tokens"), "bytes"
    )


def inserts(after: DataFrame) -> DataFrame:
    return after.select(*GROUP, F.lit(1).alias("documents"), "tokens", "bytes")


def deletes(before: DataFrame) -> DataFrame:
    minus = [(-F.col(c)).alias(c) for c in ("tokens", "bytes")]
    return before.select(*GROUP, F.lit(-1).alias("documents"), *minus)


def revisions(before: DataFrame, after: DataFrame) -> DataFrame:
    """What was before goes, what is after comes, so a row may change its group too."""
    return deletes(before).union(inserts(after))


def _number(batch: int) -> str:
    return f"{batch:012d}"


class Rollup:
    """Totals under one folder of the shared store: ``batch=<number>`` for each batch, and for
    each fold ``base=<n>`` with the totals and ``held=<n>``, written before, with the numbers
    of the batches in it as ranges."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folders(self, kind: str) -> list[int]:
        """The numbers of the folders of a kind whose writing has been finished."""
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = files.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}=*/_SUCCESS"))
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found or [])

    def _base(self) -> tuple[int, list[tuple[int, int]]]:
        """The number of the last base, 0 if there is none, and what it holds."""
        base = self._folders("base")
        if not base:
            return 0, []
        held = self.spark.read.schema("low long, high long").parquet(
            f"{self.path}/held={_number(base[-1])}"
        )
        return base[-1], sorted((r["low"], r["high"]) for r in held.collect())

    def commit(self, batch: int, changes: DataFrame) -> None:
        """Add a batch of signed changes; the same batch again replaces itself. A batch that
        a base already holds is not written again."""
        if _within(batch, self._base()[1]):
            return
        sums = [F.sum(c).cast("long").alias(c) for c in SUMS]
        delta = changes.groupBy(*GROUP).agg(*sums)
        delta.write.option("partitionOverwriteMode", "static").mode("overwrite").parquet(
            f"{self.path}/batch={_number(batch)}"
        )

    def _parts(self) -> tuple[int, list[tuple[int, int]], list[int]]:
        base, held = self._base()
        return base, held, [n for n in self._folders("batch") if not _within(n, held)]

    def _sum(self, base: int, batches: list[int]) -> DataFrame:
        paths = [f"{self.path}/base={_number(base)}"] if base else []
        paths += [f"{self.path}/batch={_number(n)}" for n in batches]
        if not paths:
            return self.spark.createDataFrame([], DELTA_DDL)
        sums = [F.sum(c).cast("long").alias(c) for c in SUMS]
        parts = self.spark.read.schema(DELTA_DDL).parquet(*paths)
        return parts.groupBy(*GROUP).agg(*sums).where("documents <> 0 or tokens <> 0 or bytes <> 0")

    def totals(self) -> DataFrame:
        base, _, batches = self._parts()
        return self._sum(base, batches).where("documents <> 0")

    def compact(self) -> None:
        """Fold everything that is committed into a new base; older folders stay unread."""
        base, held, batches = self._parts()
        if not batches:
            return
        number = _number(base + 1)
        ranges = _merged([*held, *((n, n) for n in batches)])
        self.spark.createDataFrame(ranges, "low long, high long").write.mode("overwrite").parquet(
            f"{self.path}/held={number}"
        )
        self._sum(base, batches).write.mode("overwrite").parquet(f"{self.path}/base={number}")


def _within(number: int, ranges: list[tuple[int, int]]) -> bool:
    return any(low <= number <= high for low, high in ranges)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same numbers in as few ranges as will do."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def copies_gone(rows: DataFrame) -> DataFrame:
    """What goes when one row of each text stays, as changes. Rows of one text, source and
    language are added up first, so a text that very many rows hold is a row per group."""
    name = ("doc_id", "source", "lang")
    place = [c for n in name for c in (F.col(n).isNull().alias(f"no_{n}"), F.col(n))]
    groups = rows.groupBy("sha", "source", "lang").agg(
        F.count("*").alias("n"),
        F.min(F.struct(*place)).alias("least"),
        F.max("bytes_after").alias("bytes"),
        F.max("kinds").alias("kinds"),  # the same in all rows of a text but for what was before
    )
    text = Window.partitionBy("sha")
    gone = groups.withColumn("first", F.min("least").over(text)).withColumn(
        "n", F.col("n") - (F.col("least") == F.col("first")).cast("long")
    )
    return (
        gone.where("n > 0")
        .select("source", "lang", "n", "bytes", F.explode("kinds").alias("kind"))
        .select(
            "source",
            "lang",
            "kind.tokenizer",
            (-F.col("n")).alias("documents"),
            (-F.col("n") * F.col("kind.after")).alias("tokens"),
            (-F.col("n") * F.col("bytes")).alias("bytes"),
        )
    )


def corpus_totals(
    docs: DataFrame, path: str | None = None, name: str = LIBRARY, counters=COUNTERS
) -> DataFrame:
    """Totals of ``docs`` after three batches: all rows come in, runs of noise characters are
    taken out of their texts, and of equal texts all but one row go. The second batch is
    committed twice; the third comes before it and is folded into a base first. ``path`` is a
    tokenizer file, whose counts have the version ``name``; without it the patterns count alone."""
    spark = docs.sparkSession
    rollup = Rollup(spark, work_path(spark, "totals"))
    rows = materialize(revised(docs, path, name, counters), "counts")
    before, after = _side(rows, "before"), _side(rows, "after")
    rollup.commit(1, inserts(before))
    rollup.commit(3, copies_gone(rows))
    rollup.compact()
    for _ in range(2):
        rollup.commit(2, revisions(before, after))
    return rollup.totals()
