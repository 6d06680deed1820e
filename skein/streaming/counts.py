"""Streaming token counts: per batch (no carry-over) and running (stateful).

Both read a streaming DataFrame of text lines (column ``value``), from files,
a socket or Kafka message values, and write through ``foreachBatch`` into a
:class:`~skein.sinks.store.BatchStore`, one batch per id.  With a
``checkpointLocation`` a restarted query resumes after the last committed
batch; a batch that crashed before its commit keeps its id and input, and what
it had finished writing is kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.functions.text import tokens
from skein.operators.counting import count_by
from skein.sinks.store import BatchStore, offset_ranges

DEFAULT_TRIGGER = {"processingTime": "5 seconds"}
COUNTS_SCHEMA = "word string, cnt bigint"


def _latest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"), F.max("batch_id").alias("batch_id"))


def _apart(rows: DataFrame) -> DataFrame:
    return rows


def _store(spark: SparkSession, root: str, running: bool, compact_every: int = 100) -> BatchStore:
    return BatchStore(spark, root, COUNTS_SCHEMA, _latest if running else _apart, compact_every)


def start_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: dict | None = None, name: str | None = None, output_mode: str | None = None) -> StreamingQuery:
    """Start a ``foreachBatch`` query; the trigger is every 5 seconds by default."""
    w = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if output_mode:
        w = w.outputMode(output_mode)
    if name:
        w = w.queryName(name)
    return w.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def _store_batches(stream: DataFrame, out_root: str, checkpoint: str, running: bool, compact_every: int,
                   trigger: dict | None, name: str | None, output_mode: str | None = None) -> StreamingQuery:
    store = _store(stream.sparkSession, out_root, running, compact_every)
    store.claim(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        # One action only: a second one would compute a stateful batch again.
        store.write(batch.select("word", "cnt"), batch_id)

    return start_batches(stream, write, checkpoint, trigger, name, output_mode)


def per_batch_counts(
    lines: DataFrame,
    out_root: str,
    checkpoint: str,
    delimiter: str = " ",
    trigger: dict | None = None,
    name: str | None = None,
    compact_every: int = 100,
    with_offsets: bool = False,
) -> StreamingQuery:
    """Counts of each micro-batch on its own (``reduceByKey`` on a DStream).

    An empty batch yields no rows.  Compaction puts the rows of many batches into
    one part and keeps them apart by ``batch_id``.  ``with_offsets`` (for messages:
    ``topic``, ``partition``, ``offset`` beside ``value``) commits the batch's offset ranges
    together with its counts; read them with :func:`stored_offsets`.
    """
    store = _store(lines.sparkSession, out_root, False, compact_every)
    store.claim(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write(count_by(batch.select(tokens("value", delimiter).alias("word")), "word"), batch_id,
                    offset_ranges(batch) if with_offsets else None)

    return start_batches(lines, write, checkpoint, trigger, name)


def running_counts(
    lines: DataFrame,
    out_root: str,
    checkpoint: str,
    delimiter: str = " ",
    output_mode: str = "update",
    trigger: dict | None = None,
    name: str | None = None,
    compact_every: int = 100,
) -> StreamingQuery:
    """Counts accumulated over all batches so far (``updateStateByKey`` with a sum).

    The running totals live in the state store (hash-partitioned by word with
    ``spark.sql.shuffle.partitions`` fixed at first start).  ``update`` writes
    only the words whose total changed in a batch; ``complete`` writes every
    word each batch, as the original did.  Keys never expire.
    """
    counts = count_by(lines.select(tokens("value", delimiter).alias("word")), "word")
    return _store_batches(counts, out_root, checkpoint, True, compact_every, trigger, name, output_mode)


def update_state(
    rows: DataFrame,
    key: str,
    update: Callable[[tuple, Iterator[pd.DataFrame], tuple | None], tuple],
    state_schema: str,
) -> DataFrame:
    """``updateStateByKey`` with a user function, on Spark's state store.

    ``update(key, batches of new rows, old state or None)`` returns the new state
    tuple (``state_schema``).  Gives (key, state columns) for every key that a
    micro-batch touches; the rows of a key arrive in Arrow batches, so a hot key
    is never one object.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    names = [f.split()[0] for f in state_schema.split(", ")]
    key_type = rows.schema[key].dataType.simpleString()

    def run(k, batches, state):
        new = tuple(update(k, batches, tuple(state.get) if state.exists else None))
        state.update(new)
        yield pd.DataFrame([(k[0], *new)], columns=[key, *names])

    return rows.groupBy(key).applyInPandasWithState(
        run, f"{key} {key_type}, {state_schema}", state_schema, "update", GroupStateTimeout.NoTimeout)


def update_states(
    rows: DataFrame,
    key: str,
    update: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    state_schema: str,
    combine: Callable[[pd.DataFrame], pd.DataFrame] | None = None,
    combined_schema: str | None = None,
    buckets: int = 256,
) -> DataFrame:
    """``updateStateByKey`` with a user function over frames of many keys.

    ``update(new, old)`` gets a batch's rows of many keys and the states those keys have
    (``key`` and the columns of ``state_schema``; a key without one is missing) and
    returns the new state of every key of ``new``, one row each; those rows are the result.
    ``combine`` (rows of ``combined_schema``) runs per task before rows are shuffled, so that a hot
    key sends a row per Arrow batch and not each of its rows.

    A call serves one of ``buckets`` groups of keys, whose states are kept together as one value: the
    cost of a batch is a call per touched group and not per key, at the price of rewriting the
    touched groups.  Choose ``buckets`` for some thousand keys each; it is fixed at the first start.
    """
    import pyarrow as pa
    from pyspark.sql.streaming.state import GroupStateTimeout

    key_type = rows.schema[key].dataType.simpleString()
    names = [key, *[f.split()[0] for f in state_schema.split(", ")]]

    def combined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield combine(batch)

    def run(k, batches, state):
        new = pd.concat(list(batches), ignore_index=True).drop(columns="_bucket")
        held = None
        if state.exists:
            with pa.ipc.open_stream(state.get[0]) as r:
                held = r.read_all().to_pandas()
        mine = None if held is None else held[key].isin(new[key])
        old = pd.DataFrame(columns=names) if held is None else held[mine].reset_index(drop=True)
        out = update(new, old)[names]
        whole = out if held is None else pd.concat([held[~mine], out], ignore_index=True)
        table = pa.Table.from_pandas(whole, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as w:
            w.write_table(table)
        state.update((sink.getvalue().to_pybytes(),))
        yield out

    if combine is not None:
        rows = rows.mapInPandas(combined, combined_schema)
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    return rows.withColumn("_bucket", bucket).groupBy("_bucket").applyInPandasWithState(
        run, f"{key} {key_type}, {state_schema}", "states binary", "update", GroupStateTimeout.NoTimeout)


def running_states(
    lines: DataFrame,
    out_root: str,
    checkpoint: str,
    update: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
    delimiter: str = " ",
    trigger: dict | None = None,
    name: str | None = None,
    compact_every: int = 100,
    buckets: int = 256,
) -> StreamingQuery:
    """Running ``cnt`` per token by a user function over frames (:func:`update_states`).

    ``new`` has ``word`` and ``n``, its occurrences in an Arrow batch of a task; the state is ``cnt bigint``.
    """

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby("word", dropna=False, sort=False).size().rename("n").reset_index()

    words = lines.select(tokens("value", delimiter).alias("word"))
    counts = update_states(words, "word", update, "cnt bigint", combine, "word string, n bigint", buckets)
    return _store_batches(counts, out_root, checkpoint, True, compact_every, trigger, name, "update")


def stored_state(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """Keys and values that a query's state store holds after its last committed batch:
    ``key``, ``value`` (structs) and ``partition_id``, read by Spark's ``statestore`` source."""
    return spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator_id).load()


def state_partitions(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> int:
    """The number of state partitions, fixed at the query's first start (``state-metadata`` source)."""
    meta = spark.read.format("state-metadata").option("path", checkpoint).load()
    return int(meta.where(F.col("operatorId") == operator_id).select("numPartitions").first()[0])


def running_state(
    lines: DataFrame,
    out_root: str,
    checkpoint: str,
    update: Callable[[tuple, Iterator[pd.DataFrame], tuple | None], tuple],
    delimiter: str = " ",
    trigger: dict | None = None,
    name: str | None = None,
    compact_every: int = 100,
) -> StreamingQuery:
    """Running ``cnt`` per token by a user's state update function (state: ``cnt bigint``)."""
    words = lines.select(tokens("value", delimiter).alias("word"))
    return _store_batches(update_state(words, "word", update, "cnt bigint"), out_root, checkpoint, True,
                          compact_every, trigger, name, "update")


def read_batch_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """Every batch's rows ``(batch_id, word, cnt)`` (of running counts, what compaction has left of them)."""
    return _store(spark, out_root, running=False).batches().select("batch_id", "word", "cnt")


def latest_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """Current running total per word: the value from the latest batch that changed it."""
    return _store(spark, out_root, running=True).current().select("word", "cnt")


def counts_after(spark: SparkSession, out_root: str, batch_id: int) -> DataFrame:
    """Running totals as they stood after ``batch_id`` (all keys, as ``complete`` mode shows),
    as long as compaction has not merged that batch with a later one."""
    d = read_batch_counts(spark, out_root).where(F.col("batch_id") <= int(batch_id))
    return d.groupBy("word").agg(F.max_by("cnt", "batch_id").alias("cnt"))


def to_console(df: DataFrame, num_rows: int = 10, output_mode: str = "update",
               trigger: dict | None = None, checkpoint: str | None = None) -> StreamingQuery:
    """Print the first rows of each batch (``DStream.print``).

    The progress checkpoint goes below the shared scratch folder unless given.
    """
    from skein.session import fresh_dir

    ck = checkpoint or fresh_dir(df.sparkSession, "console-checkpoint")
    return (
        df.writeStream.format("console").option("numRows", num_rows).outputMode(output_mode)
        .option("checkpointLocation", ck).trigger(**(trigger or DEFAULT_TRIGGER)).start()
    )


def for_each_partition(df: DataFrame, make_writer: Callable[[int, int], object], checkpoint: str,
                       trigger: dict | None = None, output_mode: str | None = None) -> StreamingQuery:
    """Hand rows to a writer per partition and batch (``foreachPartition`` of a batch).

    ``make_writer(partition, batch_id)`` runs on the executor; a replayed batch comes with
    the same two numbers.  The writer has ``write(row)`` and may have

    * ``open()``: False refuses the partition, as one that is committed already;
    * ``commit()`` after its last row, ``abort(error)`` instead if a row failed;
    * ``close()`` at the end of either.

    Which rows a partition holds must not depend on the run for a replay to be harmless:
    place them by a key.
    """

    class Rows:
        def open(self, partition_id: int, epoch_id: int) -> bool:
            self.writer = make_writer(partition_id, epoch_id)
            ready = self._call("open")
            self.refused = ready is False
            return not self.refused

        def _call(self, name: str, *args):
            f = getattr(self.writer, name, None)
            return f(*args) if f else None

        def process(self, row) -> None:
            self.writer.write(row)

        def close(self, error) -> None:
            if self.refused:
                return
            try:
                self._call("abort", error) if error is not None else self._call("commit")
            finally:
                self._call("close")

    w = df.writeStream.foreach(Rows()).option("checkpointLocation", checkpoint)
    if output_mode:
        w = w.outputMode(output_mode)
    return w.trigger(**(trigger or DEFAULT_TRIGGER)).start()


def stored_offsets(spark: SparkSession, out_root: str) -> DataFrame:
    """batch_id, topic, partition, from_offset, until_offset of every batch in the store: the durable
    record (``HasOffsetRanges`` and the original's saved offsets), committed with the output."""
    return _store(spark, out_root, running=False).offsets()


def batch_offsets(query: StreamingQuery) -> list[dict]:
    """Ids and source offsets of the batches in this query's recent progress reports.

    For watching a running query: Spark keeps its last 100 reports (see
    ``spark.sql.streaming.numRecentProgressUpdates``); :func:`stored_offsets` has all batches."""
    out = []
    for p in query.recentProgress:
        for src in p.get("sources", []):
            out.append({"batch_id": p["batchId"], "source": src.get("description"),
                        "start": src.get("startOffset"), "end": src.get("endOffset"),
                        "rows": src.get("numInputRows")})
    return out
