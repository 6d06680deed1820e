"""A writer per partition and batch whose ledger makes replays harmless.

The rows of a partition go to a staged file; committing it renames it to
``epoch=<batch>/partition=<p>.jsonl``.  That file's existence is the ledger's entry: a
replayed (partition, batch) finds it and is refused before a row is written, and a
partition that failed has none and is written again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from skein.storage import exists, qualified, store_of


class PartitionFile:
    """Rows of one partition and batch as JSON lines, committed by a rename."""

    def __init__(self, root: str, partition: int, epoch: int):
        self.store, at = store_of(root)
        self.folder = f"{at}/epoch={epoch}"
        self.target = f"{self.folder}/partition={partition}.jsonl"
        self.staged, self.out = "", None

    def open(self) -> bool:
        """False if this partition and batch are committed already."""
        if exists(self.store, self.target):
            return False
        self.store.create_dir(self.folder)
        self.staged = f"{self.folder}/_staged-{uuid.uuid4().hex[:12]}"
        self.out = self.store.open_output_stream(self.staged)
        return True

    def write(self, row) -> None:
        self.out.write(json.dumps(row.asDict(recursive=True), default=str).encode() + b"\n")

    def commit(self) -> None:
        self.out.close()
        self.store.move(self.staged, self.target)

    def abort(self, error: Exception) -> None:
        self.out.close()
        self.store.delete_file(self.staged)


def partition_files(spark: SparkSession, root: str):
    """``make_writer`` for :func:`skein.streaming.for_each_partition`: :class:`PartitionFile` below ``root``."""
    uri = qualified(spark, root)
    return lambda partition, epoch: PartitionFile(uri, partition, epoch)


def read_partition_files(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The committed rows with ``epoch`` (their batch)."""
    return spark.read.schema(f"{schema}, epoch bigint").option("basePath", root).option(
        "pathGlobFilter", "partition=*").json(root)
