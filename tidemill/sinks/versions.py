"""Tables whose changes are seen as a whole: numbered versions and one pointer.

A store is a folder. Rows are written into new folders, which no one reads yet; a version is a
small file that lists, for every table, the folders that make it up. Publishing a version moves
that file to the next number, which must be free. So a reader, who takes the highest number,
sees all of a change or nothing of it, whatever fails in between, also when the change has
several tables (results and the offsets they came from); of two writers who began with the same
version one is refused and has changed nothing. It needs a store with an exclusive move, as HDFS
and local disks have.

A table may be cut into parts by a column: a part's folder has the name that Spark gives it, so
no value has to be spelled here. The column itself stays in the files. The list of folders
passes through the driver; it is as long as the number of parts, never of rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.plans.bounds import checked_broadcast, null_safe
from tidemill.session import materialize, qualified
from tidemill.sinks.keyed import latest_per_key, live_metrics

PART = "_part"
WHOLE = "whole"


class Conflict(RuntimeError):
    """Another writer has published a version since this change began."""


@dataclass
class Table:
    """A table of a version: its columns, and the folders of each part."""

    schema: str
    parts: dict[str, list[str]] = field(default_factory=dict)

    def folders(self) -> list[str]:
        return [f for names in self.parts.values() for f in names]


@dataclass
class Version:
    number: int
    tables: dict[str, Table]


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, qualified(spark, root.rstrip("/"))
        self._fs = spark._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, *names: str):
        return self._fs.Path("/".join([self.root, *names]))

    def _store(self):
        return self._path().getFileSystem(self._conf)

    def numbers(self) -> list[int]:
        found = self._store().globStatus(self._path("_versions", "[0-9]*"))
        return sorted(int(f.getPath().getName()) for f in found or [])

    def version(self, number: int | None = None) -> Version:
        """A published version; the last one if no number is given, 0 if there is none."""
        numbers = self.numbers()
        number = number if number is not None else (numbers[-1] if numbers else 0)
        if not number:
            return Version(0, {})
        lines = self.spark.read.text(self._path("_versions", f"{number:012d}").toString(), wholetext=True)
        tables = json.loads(lines.first()[0])
        return Version(number, {name: Table(**table) for name, table in tables.items()})

    def read(self, name: str, number: int | None = None) -> DataFrame:
        return self._frame(self.version(number).tables[name])

    def _frame(self, table: Table, folders: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table.schema))
        folders = table.folders() if folders is None else folders
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [self._path("data", f).toString() for f in folders]
        # each folder is a root of its own, so that no column is taken from its name
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def change(self) -> Change:
        return Change(self, self.version())

    def _publish(self, version: Version) -> None:
        """Write the list aside, then move it to its number."""
        text = json.dumps({n: vars(t) for n, t in version.tables.items()})
        aside = self._path("_versions", f"_{uuid.uuid4().hex}")
        out = self._store().create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self._move(aside, self._path("_versions", f"{version.number:012d}"))

    def _move(self, source, target) -> None:
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(
            getattr(self._fs, "Options$Rename"), 0
        )
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        try:
            context.rename(source, target, none)
        except Py4JJavaError as error:
            if not self._store().exists(target):
                raise
            self._store().delete(source, False)
            raise Conflict(f"{target.getName()} of {self.root} is another writer's") from error

    def forget(self, keep: int = 2) -> None:
        """Delete all but the last ``keep`` versions, and folders that none of those lists. For
        times without a writer: what one has written and not published goes too."""
        numbers, store = self.numbers(), self._store()
        kept = {
            folder
            for number in numbers[-keep:]
            for table in self.version(number).tables.values()
            for folder in table.folders()
        }
        for number in numbers[:-keep]:
            store.delete(self._path("_versions", f"{number:012d}"), False)
        for write in store.globStatus(self._path("data", "*")) or []:
            for part in store.listStatus(write.getPath()):
                name = f"{write.getPath().getName()}/{part.getPath().getName()}"
                if part.isDirectory() and name not in kept:
                    store.delete(part.getPath(), True)


class Change:
    """What is to become the next version. Nothing is seen before ``commit``."""

    def __init__(self, store: Store, base: Version):
        self.store, self.base = store, base
        self.tables = {n: Table(t.schema, dict(t.parts)) for n, t in base.tables.items()}

    def _table(self, name: str, schema: T.StructType) -> Table:
        # files do not say what may be null
        wide = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
        return self.tables.setdefault(name, Table(wide.json()))

    def _write(self, rows: DataFrame, by: str | None) -> dict[str, list[str]]:
        """Write the rows into new folders: part -> folders."""
        write = uuid.uuid4().hex
        part = F.col(f"`{by}`") if by else F.lit(WHOLE)
        target = self.store._path("data", write)
        rows.withColumn(PART, part).write.partitionBy(PART).parquet(target.toString())
        found = self.store._store().globStatus(self.store._path("data", write, f"{PART}=*"))
        names = [f.getPath().getName() for f in found or []]
        return {n: [f"{write}/{n}"] for n in names}

    def put(self, name: str, rows: DataFrame, by: str | None = None, part: str | None = None) -> None:
        """Add rows. With ``part``, they become that part and replace what it held, so the same
        batch written again is there once."""
        table = self._table(name, rows.schema)
        written = self._write(rows, by)
        if part is not None:
            table.parts[part] = [f for names in written.values() for f in names]
            return
        for key, folders in written.items():
            table.parts[key] = table.parts.get(key, []) + folders

    def replace(self, name: str, rows: DataFrame, by: str, gone: list[str]) -> None:
        """Drop whole parts, and put rows in whose parts replace those of the same name."""
        table = self._table(name, rows.schema)
        for key in gone:
            table.parts.pop(key, None)
        table.parts.update(self._write(rows, by))

    def upsert(
        self, name: str, changes: DataFrame, keys: list[str], sequence: str, by: str | None = None
    ) -> None:
        """Put changes in; of several changes of a key the last one counts. Only folders that
        hold a changed key are written anew, found by reading the keys alone; a key may move to
        another part. A NULL key is a key like any other."""
        store = self.store
        columns = [f.name for f in self._columns(name, changes, sequence)]
        latest = materialize(latest_per_key(changes, keys, [sequence]).select(*columns), "latest")
        table = self._table(name, latest.schema)
        changed = checked_broadcast(latest.select(*keys))
        base = store._frame(table)
        held = base.select(*keys, F.col("_metadata.file_path").alias("_file")) if table.folders() else None
        touched: list[str] = []
        if held is not None:
            hit = held.join(changed, null_safe(held, changed, [(k, k) for k in keys]), "left_semi")
            parts = F.slice(F.split("_file", "/"), -3, 2)  # the folder below data, and the part
            touched = [r[0] for r in hit.select(F.concat_ws("/", parts)).distinct().collect()]
        rows = latest
        if touched:
            # the part as a path spells it may be encoded; a folder is told by its own listing
            spelled = {store._path("data", f).toUri().getRawPath().split("/data/")[-1]: f for f in table.folders()}
            spelled |= {f: f for f in table.folders()}
            touched = [spelled[f] for f in touched]
            old = store._frame(table, touched)
            kept = old.join(changed, null_safe(old, changed, [(k, k) for k in keys]), "left_anti")
            rows = kept.select(*columns).unionByName(latest)
        table.parts = {
            key: left for key, names in table.parts.items() if (left := [f for f in names if f not in touched])
        }
        for key, folders in self._write(rows, by).items():
            table.parts[key] = table.parts.get(key, []) + folders

    def _columns(self, name: str, changes: DataFrame, sequence: str) -> list[T.StructField]:
        if name in self.tables:
            return T.StructType.fromJson(json.loads(self.tables[name].schema)).fields
        return [f for f in changes.schema.fields if f.name != sequence]

    def commit(self) -> int:
        """Publish; raises ``Conflict`` if another change was published since this one began."""
        number = self.base.number + 1
        self.store._publish(Version(number, self.tables))
        return number


def expire_metrics(
    store: Store, name: str, now: Column, ttl_hours: int = 24, versions: int = 10
) -> int:
    """Compaction of a metric table that is parted by ``day``: days past the time to live go as a
    whole, without a look at their rows; of the others only days with a row to drop are
    written anew."""
    change = store.change()
    table = change.tables[name]
    since = now - F.make_interval(hours=F.lit(ttl_hours))
    cut = store.spark.range(1).select(since.cast("date").cast("string")).first()[0]
    dated = {part: part.removeprefix(f"{PART}=") for part in table.parts}
    gone = [part for part, day in dated.items() if day < cut]
    left = store._frame(table, [f for p, names in table.parts.items() if p not in gone for f in names])
    live = live_metrics(left, now, ttl_hours, versions)
    rows = F.count(F.lit(1))
    before = left.groupBy("day").agg(rows.alias("had"))
    after = live.groupBy(F.col("day").alias("_day")).agg(rows.alias("has"))
    both = before.join(after, F.col("day") == F.col("_day"), "left")
    fewer = [r["day"] for r in both.where(F.col("had") > F.coalesce("has", F.lit(0))).collect()]
    gone += [part for part, day in dated.items() if day in {str(d) for d in fewer}]
    change.replace(name, live.where(F.col("day").isin(fewer)), "day", gone)
    return change.commit()
