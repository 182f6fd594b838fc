"""Declared schemas of the input tables; no inference job is run to read them."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import work_path
from tidemill.sources.streams import file_stream, move_in

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def stream_glob(path: str) -> str:
    """A pattern that matches only ``path``: a file stream takes a folder or a pattern,
    and a table may be one file or a folder of files."""
    return f"{path[:-1]}[{path[-1]}]"


class Tables:
    """``tables.events`` reads ``<root>/events.parquet`` with its declared schema."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def stream(self, name: str, **options) -> DataFrame:
        """The table as a stream of its files."""
        return file_stream(
            self.spark, "parquet", stream_glob(self.path(name)), SCHEMAS[name], **options
        )

    def split(self, name: str, moment: str, files: int = 4) -> str:
        """A copy of the table in at least ``files`` files, each a range of ``moment``; a file
        stream over it has several micro-batches."""
        table = getattr(self, name)
        folder = work_path(self.spark, f"{name}-split")
        table.repartitionByRange(max(files, table.rdd.getNumPartitions()), moment).write.parquet(
            folder
        )
        return folder

    def arrivals(self, name: str, moment: str, folder: str, spans: int = 4) -> Iterator[int]:
        """The table's rows come into ``folder`` a span of ``moment`` after the other; the number
        of a span is yielded when its files are there, for a run of a stream that settles by
        the watermark."""
        table = getattr(self, name)
        at = F.unix_micros(F.col(moment).cast("timestamp"))
        low, high = table.agg(F.min(at), F.max(at)).first()
        step = ((high or 0) - (low or 0)) // spans + 1
        staged = work_path(self.spark, f"{name}-spans")
        span = F.expr("_at div _step").cast("int").alias("_span")
        timed = table.select("*", (at - F.lit(low or 0)).alias("_at"), F.lit(step).cast("bigint").alias("_step"))
        # one pass over the table; the files of a span move in when it is its turn
        timed.where("_at is not null").select(*table.columns, span).write.partitionBy("_span").parquet(staged)
        for n in range(spans):
            if not move_in(self.spark, f"{staged}/_span={n}", folder, f"{n}-"):
                table.limit(0).write.mode("append").parquet(folder)
            yield n

    def stream_of(self, name: str, folder: str, **options) -> DataFrame:
        """Files of the table's schema as a stream."""
        return file_stream(self.spark, "parquet", folder, SCHEMAS[name], **options)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))
