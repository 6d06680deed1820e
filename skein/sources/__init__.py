"""Readers: parquet tables, text lines, in-memory rows, JDBC ranges, Kafka and sockets."""

from skein.sources.charset import read_lines_in
from skein.sources.files import read_id_ranges, read_ip_rules, read_lines, read_table, rows
from skein.sources.jdbc import range_predicates, read_jdbc_range
from skein.sources.kafka import (
    allow_java_charsets,
    decode_value,
    kafka_stream,
    message_values,
    starting_offsets_json,
)
from skein.sources.messages import append_messages, message_stream
from skein.sources.socket import socket_lines

__all__ = [
    "append_messages",
    "allow_java_charsets",
    "decode_value",
    "kafka_stream",
    "message_stream",
    "message_values",
    "range_predicates",
    "read_id_ranges",
    "read_ip_rules",
    "read_jdbc_range",
    "read_lines",
    "read_lines_in",
    "read_table",
    "rows",
    "socket_lines",
    "starting_offsets_json",
]
