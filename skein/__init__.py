"""skein: log, text and order analytics as Spark DataFrame / Structured Streaming jobs.

Sub-packages
------------
functions   column expressions (tokenising, URL parts, IP numbers, record parsers)
sources     readers: text lines, rows, JDBC ranges, Kafka/socket option builders
operators   counts, sums, field stats, sorts, top-N, range join, key partitioning
sinks       tuple-text writer, JDBC append, idempotent totals table
streaming   per-batch and running counts, running order totals, resumable runs
plans       the registered queries over the driver tables (see ``skein.plans.catalog``)
"""

from skein.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
