"""Structured Streaming jobs: per-batch counts, running counts, running order totals."""

from skein.streaming.counts import (
    batch_offsets,
    counts_after,
    for_each_partition,
    latest_counts,
    per_batch_counts,
    read_batch_counts,
    running_counts,
    running_state,
    running_states,
    state_partitions,
    stored_offsets,
    stored_state,
    to_console,
    update_state,
    update_states,
)
from skein.streaming.orders import order_deltas, order_totals_stream

__all__ = [
    "batch_offsets",
    "counts_after",
    "for_each_partition",
    "latest_counts",
    "order_deltas",
    "order_totals_stream",
    "per_batch_counts",
    "read_batch_counts",
    "running_counts",
    "running_state",
    "running_states",
    "state_partitions",
    "stored_offsets",
    "stored_state",
    "to_console",
    "update_state",
    "update_states",
]
