"""Per-batch output of a stream with exactly-once reads, its offsets, and compaction as it grows.

Layout below ``root``::

    owner                          text: the query this store belongs to
    data/<part>/rows, offsets      rows of a batch or of merged batches; their offset ranges
    manifest/<number>.json         what counts: the parts, and the last batch

A batch's rows and its offset ranges are written first; the manifest that names them
both is put in one rename, so either both count or neither, and a batch that crashed in
between leaves a folder that nothing names.  A replayed batch is told by the manifest's
last batch and left alone.  Writer and readers look at one small file, not at the
folders: a batch costs the same after a year as on the first day.

Compaction is in tiers: ``compact_every`` parts of one tier are merged into one of the next,
so each row is rewritten once per tier and the manifest holds at most ``compact_every``
parts per tier.  Folders that a merge replaced are removed one merge later, so a
reader that saw the manifest before still finds them.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

OFFSET_SCHEMA = "batch_id bigint, topic string, partition int, from_offset bigint, until_offset bigint"
#: Manifests that stay for readers that have listed them.
KEPT_MANIFESTS = 5


def offset_ranges(messages: DataFrame) -> DataFrame:
    """topic, partition, from_offset, until_offset (exclusive) of a batch of messages."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"))


class BatchStore:
    """Batches of rows of one ``schema`` (``batch_id bigint`` is added) and their merge.

    ``merge`` turns rows of several batches into the current rows, keeping
    ``batch_id`` (the newest) as a column, and must give the same result when
    part of its input is already merged.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, merge: Callable[[DataFrame], DataFrame],
                 compact_every: int = 100):
        self.spark, self.root, self.merge, self.compact_every = spark, root, merge, max(2, int(compact_every))
        self.schema = f"{schema}, batch_id bigint"
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._io = jvm.org.apache.commons.io.IOUtils

    # --- small files ----------------------------------------------------------

    def _at(self, *names: str):
        return self._path(os.path.join(self.root, *names))

    def _put(self, path, text: str) -> None:
        staged = self._at(f"_staged-{uuid.uuid4().hex[:12]}")
        stream = self._fs.create(staged, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        self._fs.mkdirs(path.getParent())
        if self._fs.exists(path) or not self._fs.rename(staged, path):
            self._fs.delete(staged, False)
            raise RuntimeError(f"{path.toString()} is there already: {self.root} has another writer")

    def _get(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return bytes(self._io.toByteArray(stream)).decode()
        finally:
            stream.close()

    def claim(self, owner: str) -> None:
        """Bind the store to one query; another query's claim raises.  Removes what no manifest names."""
        mark = self._at("owner")
        if self._fs.exists(mark):
            found = self._get(mark)
            if found != owner:
                raise ValueError(f"{self.root} belongs to {found}, not to {owner}")
        else:
            self._put(mark, owner)
        if self._fs.exists(self._at("data")):
            _, state = self._state()
            named = {p["name"] for p in state["parts"]} | set(state["old"])
            for f in self._fs.listStatus(self._at("data")):
                if f.getPath().getName() not in named:
                    self._fs.delete(f.getPath(), True)

    # --- manifests ------------------------------------------------------------

    def _state(self) -> tuple[int, dict]:
        """(number, content) of the newest manifest."""
        folder = self._at("manifest")
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        if not names:
            return -1, {"last": -1, "parts": [], "old": []}
        newest = max(names)
        return int(newest.split(".")[0]), json.loads(self._get(self._at("manifest", newest)))

    def _commit(self, number: int, state: dict) -> None:
        self._put(self._at("manifest", f"{number:012d}.json"), json.dumps(state))
        gone = self._at("manifest", f"{number - KEPT_MANIFESTS:012d}.json")
        if self._fs.exists(gone):
            self._fs.delete(gone, False)

    def _write_part(self, rows: DataFrame, offsets: DataFrame | None, tier: int, first: int, last: int) -> dict:
        name = f"{tier}-{first}-{last}-{uuid.uuid4().hex[:8]}"
        rows.write.parquet(os.path.join(self.root, "data", name, "rows"))
        if offsets is not None:
            offsets.write.parquet(os.path.join(self.root, "data", name, "offsets"))
        return {"name": name, "tier": tier, "from": first, "upto": last, "offsets": offsets is not None}

    # --- writing --------------------------------------------------------------

    def write(self, rows: DataFrame, batch_id: int, offsets: DataFrame | None = None) -> bool:
        """Add a batch with its offset ranges (as :func:`offset_ranges` gives them).

        False, and nothing written, if that batch is in.  Compacts when due.
        """
        number, state = self._state()
        batch = int(batch_id)
        if batch <= state["last"]:
            return False
        named = F.lit(batch).cast("bigint").alias("batch_id")
        if offsets is not None:
            offsets = offsets.select(named, "topic", "partition", "from_offset", "until_offset").coalesce(1)
        part = self._write_part(rows.withColumn("batch_id", F.lit(batch).cast("bigint")), offsets, 0, batch, batch)
        state["parts"].append(part)
        state["last"] = batch
        self._commit(number + 1, state)
        tier = 0
        while sum(p["tier"] == tier for p in state["parts"]) >= self.compact_every:
            self._merge_parts([p for p in state["parts"] if p["tier"] == tier], tier + 1)
            _, state = self._state()
            tier += 1
        return True

    def _merge_parts(self, parts: list[dict], tier: int) -> None:
        number, state = self._state()
        ranges = self._load_offsets(parts) if any(p["offsets"] for p in parts) else None
        merged = self._write_part(self.merge(self._load(parts)), None if ranges is None else ranges.coalesce(1), tier,
                                  min(p["from"] for p in parts), max(p["upto"] for p in parts))
        names = {p["name"] for p in parts}
        gone, state["old"] = state["old"], sorted(names)
        state["parts"] = [p for p in state["parts"] if p["name"] not in names] + [merged]
        self._commit(number + 1, state)
        for name in gone:
            self._fs.delete(self._at("data", name), True)

    def compact(self) -> None:
        """Merge all parts into one."""
        _, state = self._state()
        if len(state["parts"]) > 1:
            self._merge_parts(state["parts"], max(p["tier"] for p in state["parts"]) + 1)

    # --- reading --------------------------------------------------------------

    def _load(self, parts: list[dict]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(
            *[os.path.join(self.root, "data", p["name"], "rows") for p in parts])

    def _load_offsets(self, parts: list[dict]) -> DataFrame:
        folders = [os.path.join(self.root, "data", p["name"], "offsets") for p in parts if p["offsets"]]
        if not folders:
            return self.spark.createDataFrame([], OFFSET_SCHEMA)
        return self.spark.read.schema(OFFSET_SCHEMA).parquet(*folders)

    def batches(self) -> DataFrame:
        """Rows of all parts, unmerged but for what compaction has merged."""
        return self._load(self._state()[1]["parts"])

    def current(self) -> DataFrame:
        """The merged rows of everything written."""
        return self.merge(self.batches())

    def offsets(self) -> DataFrame:
        """batch_id, topic, partition, from_offset, until_offset of every batch written with them."""
        return self._load_offsets(self._state()[1]["parts"])

    def last_batch(self) -> int:
        """The newest batch that counts, -1 if none does."""
        return int(self._state()[1]["last"])
