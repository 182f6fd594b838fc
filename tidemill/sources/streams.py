"""Streaming sources."""

from __future__ import annotations

import json
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemill.session import qualified
from tidemill.sinks.streams import open_store
from tidemill.sources.files import MICROS

FILES_PER_TRIGGER = 1_000
LINE_SPLIT_BYTES = 128 * 1024 * 1024
READ_BYTES = 1024 * 1024
KEEP_ENTRIES = 1_000


def file_options(
    files_per_trigger: int = FILES_PER_TRIGGER,
    latest_first: bool = False,
    file_name_only: bool = False,
) -> dict[str, str]:
    """``maxFilesPerTrigger`` is also the rate cap of a file stream."""
    return {
        "maxFilesPerTrigger": str(files_per_trigger),
        "latestFirst": str(latest_first).lower(),
        "fileNameOnly": str(file_name_only).lower(),
    }


def file_stream(
    spark: SparkSession, fmt: str, path: str, schema: str, **options
) -> DataFrame:
    """A folder (or file) as a stream; files need a declared schema."""
    reader = spark.readStream.format(fmt).schema(schema)
    return reader.options(**{**MICROS, **file_options(**options)}).load(path)


def text_stream(spark: SparkSession, path: str, **options) -> DataFrame:
    """Lines (column ``value``) of the text files that appear in a folder."""
    return spark.readStream.format("text").options(**file_options(**options)).load(path)


def event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermarks need an instant: a zone-less time is read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, delay)


def socket_stream(spark: SparkSession, host: str, port: int) -> DataFrame:
    """For trying things out: a socket cannot be read again after a failure."""
    return spark.readStream.format("socket").options(host=host, port=str(port)).load()


def rate_stream(
    spark: SparkSession, rows_per_second: int, partitions: int = 1, ramp_up: str = "0s"
) -> DataFrame:
    reader = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second)
    return reader.option("numPartitions", partitions).option("rampUpTime", ramp_up).load()


def push(df: DataFrame, queue: str) -> None:
    """Add one batch to a queue folder."""
    df.write.mode("append").parquet(queue)


def queue_stream(
    spark: SparkSession, queue: str, schema: str, one_at_a_time: bool = False
) -> DataFrame:
    """Batches pushed to a folder, all that wait per trigger or one file at a time."""
    per_trigger = 1 if one_at_a_time else FILES_PER_TRIGGER
    return file_stream(spark, "parquet", queue, schema, files_per_trigger=per_trigger)


def move_in(spark: SparkSession, written: str, folder: str, prefix: str) -> int:
    """Put the finished part files of ``written`` into ``folder`` under names with a prefix; their number."""
    fs = spark._jvm.org.apache.hadoop.fs
    target = fs.Path(folder)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target)
    files = store.globStatus(fs.Path(f"{written}/part-*")) or []
    for file in files:
        store.rename(file.getPath(), fs.Path(target, prefix + file.getPath().getName()))
    return len(files)


class LineSplit(InputPartition):
    """Bytes ``start`` to ``end`` of a file: the lines whose first byte lies in there."""

    def __init__(self, name: str, start: int, end: int, entry: int):
        super().__init__((name, start, end, entry))
        self.name, self.start, self.end, self.entry = name, start, end, entry


class LineReader(DataSourceStreamReader):
    """Offset n means entry n of a log. An entry lists files (path, size) that no earlier entry
    has, whatever their names and times, so a file is read once, and a batch that is repeated
    has the lines it had. Large files are split over tasks. An entry has at most
    ``files_per_batch`` files; files left over are in the next, which is the next batch of a query
    that goes on, or the next run of one that ends (``run_until_read``).

    Entries that were read long ago are folded: a list of the files that are still in the folder
    takes the place of the entries up to a number, so what a start reads and the driver holds
    follows the folder, not the stream's life. ``start`` is where a new checkpoint begins, not
    before what is folded and not after the last entry.
    """

    def __init__(self, options: dict):
        self.path, self.log = options["path"], options["log"]
        self.split_bytes = int(options["splitbytes"])
        self.files_per_batch = int(options["filesperbatch"])
        self.keep = int(options["keepentries"])
        self.start = int(options.get("start", 0))
        self.with_entry = options.get("withentry") == "true"
        store, folder = open_store(self.log)
        store.create_dir(folder, recursive=True)
        names = [f.base_name for f in store.get_file_info(pafs.FileSelector(folder))]
        self.folded = max((int(n[5:]) for n in names if n.startswith("seen-")), default=0)
        self.entries = max([self.folded, *(int(n) for n in names if n.isdigit())])
        self.seen = set(self._load(f"seen-{self.folded:09d}") if self.folded else [])
        for number in range(self.folded + 1, self.entries + 1):
            self.seen.update(name for name, _ in self._entry(number))

    def _load(self, name: str) -> list:
        store, folder = open_store(self.log)
        with store.open_input_stream(f"{folder}/{name}") as source:
            return json.loads(source.read())

    def _save(self, name: str, what: list) -> None:
        """Written aside and moved, so that a file is whole or not there."""
        store, folder = open_store(self.log)
        with store.open_output_stream(f"{folder}/.{name}") as out:
            out.write(json.dumps(what).encode())
        store.move(f"{folder}/.{name}", f"{folder}/{name}")

    def _entry(self, number: int) -> list[tuple[str, int]]:
        return [tuple(file) for file in self._load(f"{number:09d}")]

    def initialOffset(self) -> dict:
        return {"entry": min(max(self.start, self.folded), self.entries)}

    def _files(self) -> list[tuple[str, int]]:
        store, root = open_store(self.path)
        found = store.get_file_info(pafs.FileSelector(root))
        return sorted((f.path, f.size) for f in found if f.is_file and f.base_name[0] not in "._")

    def waiting(self) -> list[tuple[str, int]]:
        """Files that no entry has."""
        return [file for file in self._files() if file[0] not in self.seen]

    def latestOffset(self) -> dict:
        files = self.waiting()[: self.files_per_batch]
        if files:
            self._save(f"{self.entries + 1:09d}", files)
            self.entries += 1
            self.seen.update(name for name, _ in files)
        return {"entry": self.entries}

    def commit(self, end: dict) -> None:
        """Fold once there are twice as many entries before ``end`` as are to be kept."""
        last = end["entry"] - self.keep
        if last - self.folded < self.keep:
            return
        later = {name for n in range(last + 1, self.entries + 1) for name, _ in self._entry(n)}
        there = {name for name, _ in self._files()}
        self._save(f"seen-{last:09d}", sorted((self.seen & there) - later))
        store, folder = open_store(self.log)
        gone = [f"{n:09d}" for n in range(self.folded + 1, last + 1)]
        if self.folded:
            gone.append(f"seen-{self.folded:09d}")
        self.folded, self.seen = last, (self.seen & there) | later
        for name in gone:
            store.delete_file(f"{folder}/{name}")

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [
            LineSplit(name, at, min(size, at + self.split_bytes), number)
            for number in range(start["entry"] + 1, end["entry"] + 1)
            for name, size in self._entry(number)
            for at in range(0, size, self.split_bytes)
        ]

    def read(self, partition: LineSplit) -> Iterator[pa.RecordBatch]:
        store, _ = open_store(self.path)
        with store.open_input_file(partition.name) as source:
            for lines in _line_blocks(source, partition.start, partition.end):
                values = pa.array([x.removesuffix(b"\r") for x in lines], pa.binary())
                columns = {"value": values.cast(pa.string())}
                if self.with_entry:
                    columns["entry"] = pa.array([partition.entry] * len(lines), pa.int64())
                yield pa.RecordBatch.from_pydict(columns)


def _line_blocks(source, start: int, end: int) -> Iterator[list[bytes]]:
    """The lines that begin at a byte from ``start`` to before ``end``, block by block."""
    at, rest = max(0, start - 1), b""
    source.seek(at)
    cut = -1
    while start and cut < 0:  # the line that holds the byte before ``start`` is another's
        block = source.read(READ_BYTES)
        if not block:
            return
        cut = block.find(b"\n")
        at, rest = (at + cut + 1, block[cut + 1 :]) if cut >= 0 else (at + len(block), b"")
    while at < end:  # ``at`` is the place of the first byte of ``rest``, where a line begins
        block = source.read(READ_BYTES)
        rest += block
        last = rest.find(b"\n", end - at - 1)  # ends the last line that begins before ``end``
        if last >= 0 or not block:
            lines = rest[: last + 1] if last >= 0 else rest
            if lines:
                yield lines.removesuffix(b"\n").split(b"\n")
            return
        whole = rest.rfind(b"\n") + 1
        if whole:
            yield rest[: whole - 1].split(b"\n")
            at, rest = at + whole, rest[whole:]


class LineSource(DataSource):
    """Custom source: lines of the files that appear in a folder."""

    @classmethod
    def name(cls) -> str:
        return "tidemill_lines"

    def schema(self) -> str:
        return "value string" + ", entry bigint" * (self.options.get("withEntry") == "true")

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LineReader({name.lower(): value for name, value in dict(self.options).items()})


def _register_by_value(spark: SparkSession, source: type[DataSource]) -> None:
    """Plans of Python sources are made in processes that no package is shipped to, so the
    class goes with its code."""
    modules = [sys.modules[name] for name in (__name__, open_store.__module__)]
    for module in modules:
        cloudpickle.register_pickle_by_value(module)
    try:
        spark.dataSource.register(source)
    finally:
        for module in modules:
            cloudpickle.unregister_pickle_by_value(module)


def line_stream(
    spark: SparkSession,
    path: str,
    log: str,
    split_bytes: int = LINE_SPLIT_BYTES,
    files_per_batch: int = FILES_PER_TRIGGER,
    keep_entries: int = KEEP_ENTRIES,
    start: int | None = None,
    with_entry: bool = False,
) -> DataFrame:
    """Lines of the files in ``path``. ``log`` is a folder for what was found; checkpoints that
    follow one another may share it, and then ``start`` (a stored entry) is where a new one goes
    on, else the earliest entry. ``with_entry`` adds a column with the entry of each line. A run
    until the input is used up (``availableNow``) takes one batch of such a source."""
    _register_by_value(spark, LineSource)
    options = line_options(spark, path, log, split_bytes, files_per_batch, keep_entries)
    reader = spark.readStream.format("tidemill_lines").options(**options)
    return reader.option("start", start or 0).option("withEntry", with_entry).load()


def line_options(
    spark: SparkSession,
    path: str,
    log: str,
    split_bytes: int = LINE_SPLIT_BYTES,
    files_per_batch: int = FILES_PER_TRIGGER,
    keep_entries: int = KEEP_ENTRIES,
) -> dict[str, str]:
    return {
        "path": qualified(spark, path),
        "log": qualified(spark, log),
        "splitBytes": str(split_bytes),
        "filesPerBatch": str(files_per_batch),
        "keepEntries": str(keep_entries),
    }


def run_until_read(spark: SparkSession, path: str, log: str, run: Callable[[], None]) -> int:
    """Start a query that ends with its batch again until every file of ``path`` is in an entry;
    how many runs it took. Files that come meanwhile are read too."""
    options = {k.lower(): v for k, v in line_options(spark, path, log).items()}
    runs = 0
    while runs == 0 or LineReader(options).waiting():
        run()
        runs += 1
    return runs
