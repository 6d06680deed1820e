"""Running totals kept as per-batch deltas, so a replayed batch cannot count twice.

A streaming batch writes its deltas ``(metric, key, amount)`` once per batch id
into a :class:`~skein.sinks.store.BatchStore`; totals are the sums per (metric,
key) over its snapshot and the batches behind it.  Compared with incrementing
counters in a key-value store before the progress commit, a crash between output
and commit finds the batch written and leaves it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.sinks.store import BatchStore

TOTALS_SCHEMA = "metric string, key string, amount double"


def _sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("metric", "key").agg(F.sum("amount").alias("amount"), F.max("batch_id").alias("batch_id"))


def totals_store(spark: SparkSession, root: str, compact_every: int = 100) -> BatchStore:
    """The store of the totals below ``root``."""
    return BatchStore(spark, root, TOTALS_SCHEMA, _sums, compact_every)


def read_totals(spark: SparkSession, root: str, digits: int = 2) -> DataFrame:
    """Current totals ``(metric, key, amount)``."""
    return totals_store(spark, root).current().select("metric", "key", F.round("amount", digits).alias("amount"))
