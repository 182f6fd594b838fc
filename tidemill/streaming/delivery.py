"""Delivering results once, together with the offsets they came from."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.plans.bounds import checked_broadcast
from tidemill.session import materialize
from tidemill.sinks.keyed import write_batch
from tidemill.sinks.versions import Store
from tidemill.streaming.offsets import save_offsets
from tidemill.streaming.runner import run_each_batch


def deliver_once(
    df: DataFrame,
    results: str,
    offsets: str,
    checkpoint: str,
    positions: Callable[[DataFrame], DataFrame],
) -> None:
    """Write each batch's rows and its offsets under the batch id.

    A batch that is repeated after a failure overwrites itself in both places. The
    checkpoint decides where to go on; the offsets are there for reports. Batch ids mean
    nothing without the checkpoint that counts them, so results belong to one checkpoint:
    going on with another one (a lost or new checkpoint) is refused.
    """
    claim(df.sparkSession, results, checkpoint)

    def handle(frame: DataFrame, batch_id: int) -> None:
        frame.persist()
        try:
            write_batch(frame, batch_id, results)
            save_offsets(positions(frame), batch_id, offsets)
        finally:
            frame.unpersist()

    run_each_batch(df, handle, checkpoint)


def deliver_versions(
    df: DataFrame,
    store: Store,
    owner: str,
    checkpoint: str,
    positions: Callable[[DataFrame], DataFrame],
) -> None:
    """Each batch's rows and the offsets they reach, published as one version: a reader sees both
    or neither. ``owner`` names the checkpoint; a repeated batch replaces itself, and another
    checkpoint over the same store adds to it."""

    def handle(frame: DataFrame, batch_id: int) -> None:
        frame.persist()
        try:
            change = store.change()
            change.put("results", frame, part=f"{owner}-{batch_id}")
            change.put("offsets", positions(frame), part=f"{owner}-{batch_id}")
            change.commit()
        finally:
            frame.unpersist()

    run_each_batch(df, handle, checkpoint)


def claim(spark: SparkSession, results: str, checkpoint: str) -> None:
    """Note in both folders that they belong together; raise if the results are another's."""
    fs = spark._jvm.org.apache.hadoop.fs
    names = [fs.Path(f"{folder}/_delivery") for folder in (results, checkpoint)]
    tokens = []
    for name in names:
        store = name.getFileSystem(spark._jsc.hadoopConfiguration())
        found = store.exists(name)
        tokens.append(spark.read.text(name.toString()).first()[0] if found else None)
    if tokens[0] is None and tokens[1] is None:
        token = spark.createDataFrame([(uuid.uuid4().hex,)], "value string")
        token = materialize(token, "token")
        for name in reversed(names):  # the checkpoint's first: a claim without results is void
            token.write.mode("overwrite").text(name.toString())
    elif tokens[0] is None:
        spark.createDataFrame([(tokens[1],)], "value string").write.text(names[0].toString())
    elif tokens[0] != tokens[1]:
        raise ValueError(f"{results} holds batches of another checkpoint than {checkpoint}")


def score_with_current_rules(
    df: DataFrame, rules_path: str, on: str, value: str, results: str, checkpoint: str
) -> None:
    """Join every batch with the rules as they are at that moment; 0 without a rule."""
    spark = df.sparkSession

    def handle(frame: DataFrame, batch_id: int) -> None:
        rules = checked_broadcast(spark.read.parquet(rules_path))
        scored = frame.join(rules, on, "left").withColumn(value, F.coalesce(value, F.lit(0)))
        write_batch(scored, batch_id, results)

    run_each_batch(df, handle, checkpoint)
