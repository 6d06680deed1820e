"""Sinks: tuple text files, JDBC append, exactly-once batch stores, running totals."""

from skein.sinks.files import read_tuple_text, read_tuple_text_in_order, write_joined_text, write_tuple_text
from skein.sinks.jdbc import jdbc_append
from skein.sinks.joined import read_joined_parts, write_joined
from skein.sinks.partition_files import partition_files, read_partition_files
from skein.sinks.store import BatchStore, offset_ranges
from skein.sinks.totals import read_totals, totals_store

__all__ = [
    "BatchStore",
    "jdbc_append",
    "offset_ranges",
    "partition_files",
    "read_joined_parts",
    "read_partition_files",
    "read_totals",
    "read_tuple_text",
    "read_tuple_text_in_order",
    "totals_store",
    "write_joined",
    "write_joined_text",
    "write_tuple_text",
]
