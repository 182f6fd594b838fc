"""Row-wise stream sink."""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

from tidemill.session import qualified

SCHEMES = {"s3a": "s3", "s3n": "s3"}  # fixed values: names of one store in Hadoop and Arrow


def open_store(uri: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system of a path with a scheme, and the path in it."""
    scheme, colon, rest = uri.partition(":")
    if not colon:
        raise ValueError(f"{uri} has no scheme; qualify it on the driver")
    return pafs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


class FileWriterPerTask:
    """``foreach`` writer: one file per task and batch, under a name that does not change
    when the task runs again. Every attempt writes a hidden file of its own, which takes the
    name when it is complete and is removed if the task fails."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder = qualified(spark, folder)

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self.store, root = open_store(self.folder)
        self.store.create_dir(root, recursive=True)
        self.name = f"{root}/{epoch_id:08d}-{partition_id:06d}.json"
        self.part = f"{root}/.{epoch_id:08d}-{partition_id:06d}-{uuid.uuid4().hex}"
        self.out = self.store.open_output_stream(self.part)
        return True

    def process(self, row) -> None:
        self.out.write((json.dumps(row.asDict(), default=str) + "\n").encode())

    def close(self, error) -> None:
        self.out.close()
        if error is None:
            self.store.move(self.part, self.name)
        else:
            self.store.delete_file(self.part)
