"""Running order totals from a message stream: total income, per item, per region.

Per batch: message bytes -> text (charset) -> order records -> region of the
IP (range lookup) -> one grouping-sets aggregate giving all three totals in a
single pass -> deltas written once for that batch id (see :mod:`skein.sinks.totals`).
Empty batches contribute nothing.  The rule index is prepared once, outside the
batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skein.functions.net import ip_to_long
from skein.functions.records import parse_orders
from skein.operators.rangejoin import RangeIndex
from skein.sinks.store import offset_ranges
from skein.sinks.totals import totals_store
from skein.sources.kafka import message_values
from skein.streaming.counts import start_batches

TOTAL_KEY = "TOTAL_INCOME"  # fixed value: key of the overall income total
UNKNOWN_REGION = "未知"  # fixed value: region label when no rule matches


def order_deltas(records: DataFrame, index: RangeIndex, unknown: str = UNKNOWN_REGION) -> DataFrame:
    """``(metric, key, amount)`` for one batch of ``(ip, item, price)`` records.

    metric ``total`` (key ``TOTAL_INCOME``), ``item`` and ``province``; the
    three come from one ``groupingSets`` aggregate (``grouping_id`` 3, 1, 2).
    """
    enriched = index.lookup(records.withColumn("_ipn", ip_to_long("ip")), "_ipn", {"province": unknown})
    g = enriched.groupingSets([[], ["item"], ["province"]], "item", "province").agg(
        F.sum("price").alias("amount"), F.grouping_id().alias("_gid"), F.count(F.lit(1)).alias("_n")
    )
    gid = F.col("_gid")
    # An empty batch still yields the global grouping set (with a NULL sum):
    # dropping rows that saw no record skips empty batches without probing them.
    return g.where(F.col("_n") > 0).select(
        F.when(gid == 3, F.lit("total")).when(gid == 1, F.lit("item")).otherwise(F.lit("province")).alias("metric"),
        F.when(gid == 3, F.lit(TOTAL_KEY)).when(gid == 1, F.col("item")).otherwise(F.col("province")).alias("key"),
        F.col("amount").cast("double").alias("amount"),
    )


def order_totals_stream(
    messages: DataFrame,
    index: RangeIndex,
    totals_root: str,
    checkpoint: str,
    charset: str = "UTF-8",
    trigger: dict | None = None,
    after_write: Callable[[int], None] | None = None,
    name: str | None = None,
    compact_every: int = 100,
    with_offsets: bool = False,
) -> StreamingQuery:
    """Start the running-totals query over a message stream (Kafka source schema).

    ``after_write(batch_id)`` runs after a batch's deltas are written and
    before Spark commits the batch (a hook for failure tests).  ``with_offsets`` commits
    each batch's offset ranges together with its deltas.
    """
    store = totals_store(messages.sparkSession, totals_root, compact_every)
    store.claim(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        records = parse_orders(message_values(batch, charset))
        store.write(order_deltas(records, index), batch_id, offset_ranges(batch) if with_offsets else None)
        if after_write is not None:
            after_write(batch_id)

    return start_batches(messages, write, checkpoint, trigger, name)
