"""Socket text source (connector only; tests replay files instead)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Streaming lines from ``host:port``, column ``value``."""
    return spark.readStream.format("socket").option("host", host).option("port", int(port)).load()
