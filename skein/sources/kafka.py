"""Kafka streams: subscribe, resume from saved offsets, project and decode values.

The Kafka connector jar is a deployment dependency (``spark-sql-kafka``); the
helpers only build the reader.  Progress is kept in the query checkpoint, so a
restart with the same ``checkpointLocation`` resumes where the last committed
batch ended.  An explicit offset map (from an external store) becomes the JSON
``startingOffsets`` option, used only when the checkpoint is new.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Charsets Spark 4 decodes without the legacy switch.
STANDARD_CHARSETS = ("US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32")

JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"


def allow_java_charsets(spark: SparkSession) -> None:
    """Let this session decode every charset of the JVM (``GB2312``, ``GB18030`` ...)."""
    spark.conf.set(JAVA_CHARSETS, "true")


def starting_offsets_json(topic: str, offsets: dict[int, int]) -> str:
    """``{"topic": {"0": 10001, ...}}`` for ``startingOffsets``.

    Partitions are taken as given (not assumed dense), so a topic whose saved
    map misses a partition simply starts that partition from the default.
    """
    return json.dumps({topic: {str(int(p)): int(o) for p, o in sorted(offsets.items())}})


def kafka_stream(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str,
    saved_offsets: dict[int, int] | None = None,
    starting: str = "earliest",
    extra: dict[str, str] | None = None,
) -> DataFrame:
    """Streaming DataFrame over ``topic`` (Kafka source schema).

    Offsets that are gone (aged out, topic deleted) fail the query, Spark's
    default; pass ``failOnDataLoss`` in ``extra`` to decide otherwise.
    """
    r = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets_json(topic, saved_offsets) if saved_offsets else starting)
    )
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load()


def decode_value(df: DataFrame, column: str = "value", charset: str = "UTF-8") -> Column:
    """Bytes -> text in ``charset``.

    Charsets outside the standard set (``GB2312`` ...) need a session that
    allows them, see :func:`allow_java_charsets`.
    """
    if charset.upper() not in STANDARD_CHARSETS and df.sparkSession.conf.get(JAVA_CHARSETS, "false") != "true":
        raise ValueError(f"charset {charset!r}: call allow_java_charsets(spark) first")
    return F.decode(F.col(column), charset)


def message_values(df: DataFrame, charset: str = "UTF-8") -> DataFrame:
    """The message text only (``map(_._2)``), column ``value``."""
    return df.select(decode_value(df, "value", charset).alias("value"))
