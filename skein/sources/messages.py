"""Message files: an append-only log per partition, read as a stream from any offsets.

A log is a folder of Parquet files of ``(key, value, topic, partition, offset)`` and of
commits.  :func:`append_messages` writes files in parallel; they count from the moment
the driver has put a commit naming them all, so a reader sees whole appends.  Offsets of
a partition must rise from one append to the next.

The stream reader plans by the commits alone, without opening a file: its offset is a
map ``{partition: next offset}``, an input partition is a file and the range of offsets
wanted of it.  A new query starts where ``startingOffsets`` says, a map of any
partitions (they need not be dense); partitions that it doesn't name, and those that
appear later, start at their first offset, or behind their last one with
``defaultStart=latest``.  A restart goes on from the checkpoint.  An offset in the map
that the log no longer holds fails the query.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceStreamReader, InputPartition, WriterCommitMessage,
)

from skein.storage import get, names_in, put, qualified, store_of

FORMAT = "skein_messages"
MESSAGE_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint"
_ARROW = pa.schema([("key", pa.binary()), ("value", pa.binary()), ("topic", pa.string()),
                    ("partition", pa.int32()), ("offset", pa.int64())])
#: Rows in one file, so that a large append is many input partitions.
FILE_ROWS = 200_000


@dataclass
class Files(WriterCommitMessage):
    """(partition, first offset, last offset + 1, name) of the files one task has written."""

    files: list[tuple[int, int, int, str]]


class MessageWriter(DataSourceArrowWriter):
    """Writes rows sorted by partition and offset; a file holds a run of one partition."""

    def __init__(self, path: str):
        self.path = path

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Files:
        store, root = store_of(self.path)
        store.create_dir(f"{root}/files")
        done = Files([])
        held: list[pa.RecordBatch] = []

        def flush() -> None:
            if held:
                rows = pa.Table.from_batches(held)
                low, high = pc.min_max(rows.column("offset")).as_py().values()
                name = f"{rows.column('partition')[0].as_py()}-{low}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex[:8]}.parquet"
                with store.open_output_stream(f"{root}/files/{name}") as f:
                    pq.write_table(rows, f)
                done.files.append((rows.column("partition")[0].as_py(), low, high + 1, name))
                held.clear()

        for batch in iterator:
            batch = batch.select(_ARROW.names).cast(_ARROW)
            own = batch.column("partition").to_numpy()
            at = 0
            while at < len(own):
                upto = int(at + (own[at:] == own[at]).cumprod().sum())
                if held and (held[0].column("partition")[0].as_py() != own[at] or sum(b.num_rows for b in held) >= FILE_ROWS):
                    flush()
                held.append(batch.slice(at, upto - at))
                at = upto
        flush()
        return done

    def commit(self, messages: list[Files | None]) -> None:
        store, root = store_of(self.path)
        store.create_dir(f"{root}/commits")
        number = max([int(n.split(".")[0]) for n in names_in(store, f"{root}/commits") if n.endswith(".json")], default=-1) + 1
        files = sorted(f for m in messages if m for f in m.files)
        put(store, f"{root}/commits/{number:012d}.json", json.dumps(files).encode())

    def abort(self, messages: list[Files | None]) -> None:
        store, root = store_of(self.path)
        for m in messages:
            for *_, name in m.files if m else []:
                store.delete_file(f"{root}/files/{name}")


class Slice(InputPartition):
    """Offsets ``low`` up to (not with) ``high`` of one file."""

    def __init__(self, name: str, low: int, high: int):
        self.name, self.low, self.high = name, low, high


class MessageStream(DataSourceStreamReader):
    """Options: ``path``, ``startingOffsets`` (JSON map), ``defaultStart`` (earliest or latest)."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.start = {int(p): int(o) for p, o in json.loads(options.get("startingOffsets") or "{}").items()}
        self.latest = options.get("defaultStart", "earliest") == "latest"
        self.read_commits: set[str] = set()
        self.files: list[tuple[int, int, int, str]] = []

    def _refresh(self) -> None:
        store, root = store_of(self.path)
        for name in names_in(store, f"{root}/commits"):
            if name.endswith(".json") and name not in self.read_commits:
                self.files += [tuple(f) for f in json.loads(get(store, f"{root}/commits/{name}"))]
                self.read_commits.add(name)

    def _ends(self) -> tuple[dict[int, int], dict[int, int]]:
        """(first offset, next offset) of every partition."""
        first: dict[int, int] = {}
        last: dict[int, int] = {}
        for p, low, high, _ in self.files:
            first[p], last[p] = min(low, first.get(p, low)), max(high, last.get(p, high))
        return first, last

    def initialOffset(self) -> dict:
        self._refresh()
        first, last = self._ends()
        for p, o in self.start.items():
            if o < first.get(p, 0):
                raise ValueError(f"offset {o} of partition {p} is gone; the log starts at {first[p]}")
        return {str(p): o for p, o in sorted(((last if self.latest else first) | self.start).items())}

    def latestOffset(self) -> dict:
        self._refresh()
        # A saved offset of a partition without messages yet stays in the map.
        return {str(p): o for p, o in sorted((self.start | {
            p: max(o, self.start.get(p, 0)) for p, o in self._ends()[1].items()}).items())}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self._refresh()
        out = []
        for p, low, high, name in self.files:
            a, b = max(low, int(start.get(str(p), low))), min(high, int(end.get(str(p), 0)))
            if a < b:
                out.append(Slice(name, a, b))
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        store, root = store_of(self.path)
        with store.open_input_file(f"{root}/files/{partition.name}") as f:
            for batch in pq.ParquetFile(f).iter_batches(10_000):
                o = batch.column("offset")
                yield batch.filter(pc.and_(pc.greater_equal(o, partition.low), pc.less(o, partition.high)))


class MessageLog(DataSource):
    """The format ``skein_messages``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE_SCHEMA

    def writer(self, schema, overwrite: bool) -> MessageWriter:
        if overwrite:
            raise ValueError("a message log is only appended to")
        return MessageWriter(self.options["path"])

    def streamReader(self, schema) -> MessageStream:
        return MessageStream(self.options)


def append_messages(messages: DataFrame, path: str) -> None:
    """Append rows of :data:`MESSAGE_SCHEMA` to the log; all of them count, or none."""
    spark = messages.sparkSession
    spark.dataSource.register(MessageLog)
    rows = messages.selectExpr("cast(key AS binary) key", "cast(value AS binary) value", "topic",
                               "cast(partition AS int) partition", "cast(offset AS bigint) offset")
    rows.repartitionByRange("partition", "offset").sortWithinPartitions("partition", "offset").write.format(
        FORMAT).mode("append").option("path", qualified(spark, path)).save()


def message_stream(spark: SparkSession, path: str, saved_offsets: dict[int, int] | None = None,
                   default_start: str = "earliest") -> DataFrame:
    """A stream of the log from ``saved_offsets`` (partition -> next offset) on."""
    if default_start not in ("earliest", "latest"):
        raise ValueError(f"default_start must be earliest or latest, got {default_start!r}")
    spark.dataSource.register(MessageLog)
    return (spark.readStream.format(FORMAT).option("path", qualified(spark, path))
            .option("startingOffsets", json.dumps({str(p): int(o) for p, o in (saved_offsets or {}).items()}))
            .option("defaultStart", default_start).load())
