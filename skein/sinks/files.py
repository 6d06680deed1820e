"""Tuple text output: one ``(a,b)`` line per row, part files in sort order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions.records import render_tuple
from skein.operators.ranking import SortRule, order_columns, with_position


def write_tuple_text(df: DataFrame, path: str, columns: Sequence[str], rule: SortRule | None = None,
                     mode: str = "errorifexists") -> None:
    """``saveAsTextFile`` of tuples.  With ``rule`` the rows are range-sorted
    first, so concatenating the part files in name order gives sorted output."""
    out = df.orderBy(*order_columns(rule)) if rule else df
    out.select(render_tuple(*columns).alias("value")).write.mode(mode).text(path)


def _parse_tuple(names: Sequence[str], types: Sequence[str]) -> list:
    body = F.regexp_extract("value", r"(?s)^\((.*)\)$", 1)
    # The last len(names)-1 fields never contain commas (numbers); split from the right.
    cols = []
    n = len(names)
    for i, (name, t) in enumerate(zip(names, types)):
        if i < n - 1:
            part = F.regexp_extract(body, r"(?s)^(.*)" + r",[^,]*" * (n - 1 - i) + "$", 1)
            part = F.substring_index(part, ",", -1) if i > 0 else part
        else:
            part = F.substring_index(body, ",", -1)
        part = part if t == "string" else F.when(part != "null", part)
        cols.append(part.cast(t).alias(name))
    return cols


def read_tuple_text(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """Parse ``(a,b,...)`` lines back into typed columns (flat tuples only).

    A ``null`` reads as NULL in typed columns; in a string column it stays the
    text, which the file format cannot tell from a NULL.
    """
    return spark.read.option("lineSep", "\n").text(path).select(*_parse_tuple(names, types))


def read_tuple_text_in_order(spark: SparkSession, path: str, names: Sequence[str], types: Sequence[str],
                             pos: str = "pos") -> DataFrame:
    """As :func:`read_tuple_text`, with each line's 1-based position over the part
    files in name order."""
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select("value", F.col("_metadata.file_name").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_line"))
    placed = with_position(lines, ["_file", "_block", "_line"], pos)
    return placed.select(pos, *_parse_tuple(names, types))


def write_joined_text(df: DataFrame, path: str, value: str, rule: SortRule, sep: str = " ",
                      by: str | None = None, mode: str = "errorifexists") -> None:
    """``mkString`` into files: ``value`` of all rows in ``rule`` order with ``sep`` behind
    each, one folder per value of ``by``; no row ever holds a whole joined text."""
    out = df.orderBy(*order_columns(rule))
    cols = [F.col(value).cast("string").alias("value")] + ([F.col(by)] if by else [])
    w = out.select(*cols).write.mode(mode).option("lineSep", sep)
    (w.partitionBy(by) if by else w).text(path)
