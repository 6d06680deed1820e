"""Files on the cluster's storage from Python: the driver's commits and the tasks' parts.

Spark resolves a path by its Hadoop settings; :func:`qualified` does the same on the
driver, so that a task (which has no Hadoop client) opens the same file by its full URI.
"""

from __future__ import annotations

import uuid

from pyarrow import fs as pafs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The full URI of a path under the session's Hadoop settings."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def store_of(uri: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it) of a full URI."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def exists(store: pafs.FileSystem, path: str) -> bool:
    return store.get_file_info(path).type != pafs.FileType.NotFound


def names_in(store: pafs.FileSystem, path: str) -> list[str]:
    """Base names in a folder, sorted; none if it isn't there."""
    found = store.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return sorted(i.base_name for i in found)


def put(store: pafs.FileSystem, path: str, data: bytes) -> None:
    """Write a small file so that it appears whole or not at all."""
    staged = f"{path.rpartition('/')[0]}/_staged-{uuid.uuid4().hex[:12]}"
    with store.open_output_stream(staged) as f:
        f.write(data)
    store.move(staged, path)


def get(store: pafs.FileSystem, path: str) -> bytes:
    with store.open_input_stream(path) as f:
        return f.read()
