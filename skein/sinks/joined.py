"""Joined text, byte for byte: ``mkString`` of an ordered column into files.

A Python data source writer.  Every task writes its own rows, joined, into a staged
file per group; nothing of them is seen before the driver commits.  The commit
moves the files of the successful attempts to ``part-<partition>`` and, where a separator
is due between two parts, puts it into a file of its own that sorts between them;
``_SUCCESS`` comes last.  So the files of a folder, joined in name order, are exactly
the values with the separator between them - also none - and no row, task or process
ever holds a whole joined text.  A job that fails before its commit leaves staged
files only, which its abort removes; a folder without ``_SUCCESS`` is refused by the reader.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from skein.operators.ranking import SortRule, order_columns
from skein.storage import exists, names_in, put, qualified, store_of

FORMAT = "skein_joined_text"
SUCCESS = "_SUCCESS"


@dataclass
class Parts(WriterCommitMessage):
    """What one task attempt has staged: (group folder, file) in the order written."""

    partition: int
    files: list[tuple[str, str]]


class JoinedTextWriter(DataSourceArrowWriter):
    """Options: ``path`` (full URI), ``sep``, ``by`` (name of a group column, or empty)."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.sep, self.by = options["path"], options.get("sep", "").encode(), options.get("by", "")
        self.overwrite = overwrite
        self.staging = f"_staging-{uuid.uuid4().hex[:12]}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Parts:
        store, root = store_of(self.path)
        task = TaskContext.get()
        done = Parts(task.partitionId(), [])
        out, group = None, None
        try:
            for batch in iterator:
                values = batch.column("value").to_pylist()
                groups = batch.column("by").to_pylist() if self.by else [""] * len(values)
                at = 0
                while at < len(values):
                    upto = at
                    while upto < len(values) and groups[upto] == groups[at]:
                        upto += 1
                    data = self.sep.join(("" if v is None else v).encode() for v in values[at:upto])
                    if out is None or groups[at] != group:
                        if out is not None:
                            out.close()
                        group = groups[at]
                        folder = f"{self.by}={quote('null' if group is None else group, safe='')}" if self.by else ""
                        name = f"{task.partitionId():05d}-{task.taskAttemptId()}-{len(done.files)}"
                        store.create_dir(f"{root}/{self.staging}")
                        out = store.open_output_stream(f"{root}/{self.staging}/{name}")
                        done.files.append((folder, name))
                    else:
                        out.write(self.sep)
                    out.write(data)
                    at = upto
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list[Parts | None]) -> None:
        store, root = store_of(self.path)
        store.create_dir(root)
        if self.overwrite:
            for name in names_in(store, root):
                if name != self.staging:
                    whole = f"{root}/{name}"
                    store.delete_dir(whole) if store.get_file_info(whole).type.name == "Directory" else store.delete_file(whole)
        last: dict[str, str] = {}
        for part in sorted((m for m in messages if m), key=lambda m: m.partition):
            for folder, name in part.files:
                target = f"{root}/{folder}" if folder else root
                if folder not in last:
                    store.create_dir(target)
                elif self.sep:
                    put(store, f"{target}/{last[folder]}-sep", self.sep)
                last[folder] = f"part-{part.partition:05d}"
                store.move(f"{root}/{self.staging}/{name}", f"{target}/{last[folder]}")
        if exists(store, f"{root}/{self.staging}"):
            store.delete_dir(f"{root}/{self.staging}")
        put(store, f"{root}/{SUCCESS}", b"")

    def abort(self, messages: list[Parts | None]) -> None:
        store, root = store_of(self.path)
        if exists(store, f"{root}/{self.staging}"):
            store.delete_dir(f"{root}/{self.staging}")


class JoinedText(DataSource):
    """The write-only format ``skein_joined_text`` of (value, and by)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string, by string" if self.options.get("by") else "value string"

    def writer(self, schema, overwrite: bool) -> JoinedTextWriter:
        return JoinedTextWriter(self.options, overwrite)


def write_joined(df: DataFrame, path: str, value: str, rule: SortRule, sep: str = "", by: str | None = None,
                 mode: str = "errorifexists") -> None:
    """``value`` of all rows in ``rule`` order with ``sep`` between them, one folder per value of ``by``.

    ``mode`` is ``errorifexists`` or ``overwrite``.  A NULL value is written as nothing
    (its separators stay); a NULL group's folder is named ``null``.  No rows: no part.
    Make ``rule`` a total order for reproducible bytes.
    """
    spark = df.sparkSession
    uri = qualified(spark, path)
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode must be errorifexists or overwrite, got {mode!r}")
    store, root = store_of(uri)
    if mode == "errorifexists" and names_in(store, root):
        raise FileExistsError(path)
    spark.dataSource.register(JoinedText)
    ordered = df.orderBy(*([F.col(by).asc()] if by else []), *order_columns(rule))
    cols = [F.col(value).cast("string").alias("value")] + ([F.col(by).cast("string").alias("by")] if by else [])
    w = ordered.select(*cols).write.format(FORMAT).option("path", uri).option("sep", sep).option("by", by or "")
    w.mode("overwrite" if mode == "overwrite" else "append").save()


def read_joined_parts(spark: SparkSession, path: str) -> DataFrame:
    """folder, file, content: the committed pieces; in (folder, file) order they are the text.

    Raises ``FileNotFoundError`` for a path that no job has committed.
    """
    store, root = store_of(qualified(spark, path))
    if not exists(store, f"{root}/{SUCCESS}"):
        raise FileNotFoundError(f"{path} holds no committed text")
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    at = F.col("path")
    folder = F.element_at(F.split(at, "/"), -2)
    return raw.select(F.when(folder.contains("="), folder).otherwise("").alias("folder"),
                      F.element_at(F.split(at, "/"), -1).alias("file"), "content")
