"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import math
import os
import tempfile
import uuid
import zipfile

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

MEGABYTE = 1024 * 1024
SHUFFLE_PARTITION_BYTES = 128 * MEGABYTE
MAX_SHUFFLE_PARTITIONS = 50_000
WAVES = 25


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings that follow the size of the input and of the cluster.

    Shuffles start with about 128 MB per partition and AQE merges small ones. The count is
    bounded, because a shuffle keeps one block per map and reduce partition; pruned columns
    and map-side aggregates leave far less to shuffle than was read. Scans take larger
    splits when the input would need more than 25 waves of tasks.
    """
    shuffles = min(MAX_SHUFFLE_PARTITIONS, math.ceil(input_bytes / SHUFFLE_PARTITION_BYTES))
    split = math.ceil(input_bytes / (cores * WAVES) / MEGABYTE)
    return {
        "spark.sql.shuffle.partitions": str(max(cores, shuffles)),
        "spark.sql.files.maxPartitionBytes": f"{min(1024, max(128, split))}m",
    }


def build_session(
    app: str = "tidemill",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python workers can
    import it whatever their working folder is."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tidemill-ship-"))
    archive = os.path.join(folder, "tidemill.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for place, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(place, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The size of everything under ``path``, from the store's own listing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.getContentSummary(where).getLength() if store.exists(where) else 0


def size_shuffles(spark: SparkSession, root: str | None = None) -> None:
    """On a cluster start shuffles with as many partitions as the tables under ``root`` ask
    for, three per core at least, unless the session says more; AQE merges those that stay
    small. A local session is left as it is."""
    context = spark.sparkContext
    if context.master.startswith("local") or spark.conf.get(INITIAL_PARTITIONS, None):
        return
    cores = context.defaultParallelism
    asked = cluster_conf(folder_bytes(spark, root) if root else 0, cores)
    wanted = max(3 * cores, int(asked["spark.sql.shuffle.partitions"]))
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(INITIAL_PARTITIONS, str(wanted))


STATE_PARTITIONS = "tidemill.state.partitions"
STATE_PARTITION_BYTES = 64 * MEGABYTE


def size_states(spark: SparkSession, root: str) -> None:
    """How many partitions keep the state of a stream over the tables under ``root``: one per 64 MB
    of input, one per core at least. Every one costs a commit per batch and store, however little it
    holds, so a shuffle's count, which AQE merges, is too many."""
    sized = math.ceil(folder_bytes(spark, root) / STATE_PARTITION_BYTES)
    spark.conf.set(STATE_PARTITIONS, str(max(spark.sparkContext.defaultParallelism, sized)))


def shuffle_count(spark: SparkSession) -> int:
    """The partitions that a shuffle of this session starts with."""
    return int(
        spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors are one process, falls back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tidemill-")
    context.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without is on the cluster's default file system, which
    code that runs outside Spark must not take for the local disk."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(where).toString()


_RUNS: dict[str, str] = {}


def run_folder(spark: SparkSession) -> str:
    """This application's folder under the shared one. It goes when the driver ends."""
    run = spark.sparkContext.applicationId
    if run not in _RUNS:
        _RUNS[run] = f"{qualified(spark, shared_root(spark))}/run-{run}-{uuid.uuid4().hex[:8]}"
        where = spark._jvm.org.apache.hadoop.fs.Path(_RUNS[run])
        store = where.getFileSystem(spark._jsc.hadoopConfiguration())
        atexit.register(_remove, store, where)
    return _RUNS[run]


def _remove(store, where) -> None:
    """Delete what an application wrote with ``work_path``; the session may have stopped."""
    try:
        store.delete(where, True)
    except (Py4JError, OSError):  # the JVM is gone already
        return


def work_path(spark: SparkSession, label: str) -> str:
    """A new path in the run folder; nothing is ever written there twice."""
    return f"{run_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write once to the shared folder and read back.

    Cuts the lineage, fixes non-deterministic columns, keeps column pruning, and
    the files outlive a lost executor.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
