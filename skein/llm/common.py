"""Shared helpers of the training-data operators: reading, lineage cuts, word counting."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.session import fresh_dir
from skein.sources.files import read_table

#: A word: a run of characters other than blank and the five ASCII white-space controls.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """One input table; later selects prune its columns at the scan.

    With ``spread`` a session that asks for it has small one-task scans dealt over its cores.
    """
    return read_table(spark, sf_dir, name, spread)


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would touch other alphabets too)."""
    return F.translate(c, ASCII_UPPER, ASCII_LOWER)


def word_count(text: Column) -> Column:
    """Number of words of a text as BIGINT; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back.

    A lineage cut whose files every executor can read: a lost executor only
    repeats the tasks that were running on it.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into short ones, so that a task holds few texts as Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def free_prefix(columns: list[str], base: str = "_x") -> str:
    """A prefix that no given column name starts with (ignoring case), for helper columns."""
    names = [c.lower() for c in columns]
    while any(c.startswith(base) for c in names):
        base += "_"
    return base
