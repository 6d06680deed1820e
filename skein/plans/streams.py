"""Registered streaming queries, driven by file replay.

Input rows derived from a driver table are appended to a stream folder in
``ROUNDS`` drops (drop ``r`` holds the rows with ``key % ROUNDS == r``), written
once, partitioned by drop.  After each drop the query is (re)started from its
checkpoint with ``availableNow``, so drop ``r`` becomes batch ``r`` and every
round also exercises a resume.  The order streams get a drop without rows after
the others, and their stores are compacted every second batch.  Each run uses a fresh
folder under the shared scratch root.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import StreamingQueryException

from skein.functions.text import text_lines
from skein.operators.rangejoin import RangeIndex
from skein.plans import inputs
from skein.session import fresh_dir
from skein.sinks.partition_files import partition_files, read_partition_files
from skein.sinks.totals import read_totals
from skein.sources.files import read_table
from skein.sources.messages import append_messages, message_stream
from skein.streaming.counts import (
    for_each_partition,
    latest_counts,
    per_batch_counts,
    read_batch_counts,
    running_counts,
    running_states,
    state_partitions,
    stored_offsets,
    stored_state,
)
from skein.streaming.orders import order_totals_stream

ROUNDS = 4
COMPACT_EVERY = 2
ONCE = {"availableNow": True}
MESSAGE_SCHEMA = "key binary, value binary, topic string, partition int, offset bigint"


def _doc_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents", spread=True)
    return d.select(text_lines("text").alias("value"), (F.col("doc_id") % ROUNDS).alias("_round"))


def _order_message_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as messages: value = UTF-8 bytes of the order line; 3 topic partitions."""
    o = read_table(spark, sf_dir, "orders", spread=True)
    line = inputs.order_line()
    return o.select(
        F.lit(None).cast("binary").alias("key"),
        F.encode(line, "UTF-8").alias("value"),
        F.lit("orders").alias("topic"),
        (F.col("o_orderkey") % 3).cast("int").alias("partition"),
        (F.col("o_orderkey") / 3).cast("bigint").alias("offset"),
        (F.col("o_orderkey") % ROUNDS).alias("_round"),
    )


def _run_rounds(drops: DataFrame, fmt: str, input_dir: str, start, crash_round: int | None = None,
                empty_rounds: int = 0) -> None:
    spark = drops.sparkSession
    # One pass over the source table; a round then reads its own folder.
    staged = fresh_dir(spark, "stream-drops")
    drops.write.partitionBy("_round").parquet(staged)
    schema = drops.drop("_round").schema
    for r in range(ROUNDS + empty_rounds):
        if r < ROUNDS:
            rows = spark.read.schema(drops.schema).parquet(staged).where(F.col("_round") == r).select(*schema.names)
        else:
            rows = spark.createDataFrame([], schema)
        rows.write.mode("append").format(fmt).save(input_dir)
        q = start()
        try:
            q.awaitTermination()
        except StreamingQueryException:
            if r != crash_round:
                raise
            # Restart from the checkpoint: the failed batch keeps its id and input.
            start().awaitTermination()


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of each batch on its own, ``(batch_id, word, cnt)``."""
    root = fresh_dir(spark, "stream-batch-counts")
    inp, out, ck = (os.path.join(root, x) for x in ("input", "out", "checkpoint"))
    drops = _doc_drops(spark, sf_dir)

    def start():
        return per_batch_counts(spark.readStream.text(inp), out, ck, trigger=ONCE)

    _run_rounds(drops, "text", inp, start)
    return read_batch_counts(spark, out)


def _running_counts(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(store, checkpoint) of the running counts after the last drop."""
    root = fresh_dir(spark, "stream-running-counts")
    inp, out, ck = (os.path.join(root, x) for x in ("input", "out", "checkpoint"))
    drops = _doc_drops(spark, sf_dir)

    def start():
        return running_counts(spark.readStream.text(inp), out, ck, trigger=ONCE)

    _run_rounds(drops, "text", inp, start)
    return out, ck


def stream_running_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running token counts after the last batch, ``(word, cnt)``."""
    return latest_counts(spark, _running_counts(spark, sf_dir)[0])


def stream_state_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The running counts' state itself, read back from the checkpoint: ``(word, cnt)``."""
    _, ck = _running_counts(spark, sf_dir)
    held = stored_state(spark, ck).select(F.col("key.word").alias("word"), F.col("value.count").alias("cnt"), "partition_id")
    # Every key lies in one of the partitions that the metadata names.
    n = state_partitions(spark, ck)
    return held.where((F.col("partition_id") >= 0) & (F.col("partition_id") < n)).select("word", "cnt")


def stream_state_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running token counts by a user's state update function, ``(word, cnt)``."""
    root = fresh_dir(spark, "stream-state-update")
    inp, out, ck = (os.path.join(root, x) for x in ("input", "out", "checkpoint"))

    def update(new, old):
        total = new.groupby("word", sort=False)["n"].sum()
        before = old.set_index("word")["cnt"].reindex(total.index).astype("float64").fillna(0)
        return (total + before).astype("int64").rename("cnt").reset_index()

    def start():
        return running_states(spark.readStream.text(inp), out, ck, update, trigger=ONCE)

    _run_rounds(_doc_drops(spark, sf_dir), "text", inp, start)
    return latest_counts(spark, out)


# Fixed values of the message logs: sparse topic partitions; an order's offset lies above
# those of the drops before its own.
LOG_PARTITIONS = (0, 3, 7)
LOG_STRIDE = 1_000_000_000_000


def _order_log(spark: SparkSession, sf_dir: str, rounds: int) -> DataFrame:
    """Order messages with sparse partitions and offsets that rise over ``rounds`` drops."""
    o = read_table(spark, sf_dir, "orders")
    drop = F.col("o_orderkey") % rounds
    place = F.element_at(F.array(*[F.lit(p) for p in LOG_PARTITIONS]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    return o.select(
        F.lit(None).cast("binary").alias("key"), F.encode(inputs.order_line(), "UTF-8").alias("value"),
        F.lit("orders").alias("topic"), place.alias("partition"),
        (drop * LOG_STRIDE + F.col("o_orderkey")).alias("offset"), drop.alias("_round"))


def stream_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offset ranges committed with each batch's counts: ``(batch_id, partition, from_offset, until_offset)``."""
    root = fresh_dir(spark, "stream-offsets")
    log, out, ck = (os.path.join(root, x) for x in ("log", "out", "checkpoint"))
    rows = _order_log(spark, sf_dir, ROUNDS)
    for r in range(ROUNDS):
        append_messages(rows.where(F.col("_round") == r), log)
        lines = message_stream(spark, log).select(F.decode("value", "UTF-8").alias("value"), "topic", "partition", "offset")
        per_batch_counts(lines, out, ck, trigger=ONCE, compact_every=COMPACT_EVERY, with_offsets=True).awaitTermination()
    return stored_offsets(spark, out).select("batch_id", "partition", "from_offset", "until_offset")


def stream_from_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a new query reads that starts from saved offsets: ``(partition, first_offset, cnt, total)``.

    Partition 3 starts in the middle, partition 7 near its end, partition 0 is not in the
    map and starts at its first offset.
    """
    root = fresh_dir(spark, "stream-from-offsets")
    log, out, ck = (os.path.join(root, x) for x in ("log", "out", "checkpoint"))
    rows = _order_log(spark, sf_dir, 1)
    append_messages(rows, log)
    top = rows.agg(F.max("offset")).first()[0]
    stream = message_stream(spark, log, saved_offsets={3: top // 2, 7: top - top // 10})
    price = F.element_at(F.split(F.decode("value", "UTF-8"), " "), 5).cast("double")
    q = stream.select("partition", "offset", price.alias("price")).writeStream.format("parquet").option(
        "path", out).option("checkpointLocation", ck).trigger(**ONCE).start()
    q.awaitTermination()
    read = spark.read.schema("partition int, offset bigint, price double").parquet(out)
    return read.groupBy("partition").agg(F.min("offset").alias("first_offset"), F.count(F.lit(1)).alias("cnt"),
                                         F.round(F.sum("price"), 2).alias("total"))


def stream_partition_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events handed to a ledgered writer per partition and batch: ``(epoch, event_id, event_type)``."""
    root = fresh_dir(spark, "stream-partition-writer")
    inp, out, ck = (os.path.join(root, x) for x in ("input", "out", "checkpoint"))
    events = read_table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_id") % ROUNDS).alias("_round"))
    schema = "event_id bigint, event_type string"

    def start():
        stream = spark.readStream.schema(schema).parquet(inp).repartition("event_id")
        return for_each_partition(stream, partition_files(spark, out), ck, trigger=ONCE)

    _run_rounds(events, "parquet", inp, start)
    return read_partition_files(spark, out, schema).select("epoch", "event_id", "event_type")


def _order_totals(spark: SparkSession, sf_dir: str, crash_round: int | None) -> DataFrame:
    root = fresh_dir(spark, "stream-order-totals")
    inp, out, ck = (os.path.join(root, x) for x in ("input", "totals", "checkpoint"))
    from skein.plans.catalog import ip_rules

    index = RangeIndex(ip_rules(spark, sf_dir), ["province"])
    drops = _order_message_drops(spark, sf_dir)
    crashed: set[int] = set()

    def after_write(batch_id: int) -> None:
        if crash_round is not None and batch_id == crash_round and batch_id not in crashed:
            crashed.add(batch_id)
            raise RuntimeError(f"injected failure after output of batch {batch_id}")

    def start():
        stream = spark.readStream.schema(MESSAGE_SCHEMA).parquet(inp)
        return order_totals_stream(stream, index, out, ck, trigger=ONCE, after_write=after_write,
                                   compact_every=COMPACT_EVERY)

    _run_rounds(drops, "parquet", inp, start, crash_round=crash_round, empty_rounds=1)
    if crash_round is not None and crash_round not in crashed:
        raise RuntimeError("the injected failure did not happen")
    return read_totals(spark, out)


def stream_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running income totals ``(metric, key, amount)`` over order messages."""
    return _order_totals(spark, sf_dir, crash_round=None)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`stream_order_totals`, with batch 1 failing after its output and
    before its commit, then resumed: the totals must not count it twice."""
    return _order_totals(spark, sf_dir, crash_round=1)


STREAM_QUERIES = {
    "stream_batch_counts": stream_batch_counts,
    "stream_running_counts": stream_running_counts,
    "stream_state_update": stream_state_update,
    "stream_state_dump": stream_state_dump,
    "stream_offsets": stream_offsets,
    "stream_from_offsets": stream_from_offsets,
    "stream_partition_writer": stream_partition_writer,
    "stream_order_totals": stream_order_totals,
    "stream_resume": stream_resume,
}
