"""File and in-memory sources."""

from __future__ import annotations

import os
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Session option naming into how many partitions a scan is dealt before heavy per-row work.
SPREAD_OPTION = "spark.skein.spreadScans"


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """One driver table, ``<sf_dir>/<name>.parquet``.

    Parquet keeps column pruning and predicate pushdown: later ``select`` /
    ``where`` calls reach the scan (``ReadSchema`` / ``PushedFilters``).
    ``spread`` marks tables that are read for heavy per-row work (tokenising,
    parsing).  It has an effect only if the session sets :data:`SPREAD_OPTION`:
    the rows are then dealt over that many partitions by their first column,
    which shuffles the raw rows.  That is for small files of one row group on
    one machine; leave the option unset on a cluster.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    parts = int(spark.conf.get(SPREAD_OPTION, "0")) if spread else 0
    return df.repartition(parts, df.columns[0]) if parts else df


def read_id_ranges(spark: SparkSession, path: str | Sequence[str], column: str, lo: int, hi: int,
                   num_partitions: int, number: str | None = None) -> DataFrame:
    """Rows of Parquet file(s) with ``lo <= column <= hi``, a scan partition per id range.

    The inclusive ranges are those of :func:`skein.sources.jdbc.range_bounds`.  Each is a scan
    of its own whose two bounds are pushed to the files, so row groups outside it are
    not read, and gives one partition; ``number`` names a column for the range's number.
    Sort the files by the column (or write them range-partitioned) for the pruning to pay.

    Spark 4.1 zips the partitions of a union whose inputs have one each, which would read
    all ranges in one task: the session's ``spark.sql.unionOutputPartitioning`` is set to false.
    """
    from functools import reduce

    from skein.sources.jdbc import range_bounds

    bounds = range_bounds(lo, hi, num_partitions)
    table = spark.read.parquet(*([path] if isinstance(path, str) else path))
    if not bounds:
        none = table.where("false")
        return none.withColumn(number, F.lit(0)) if number else none
    spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    parts = []
    for k, (first, last) in enumerate(bounds):
        part = table.where((F.col(column) >= F.lit(first)) & (F.col(column) <= F.lit(last))).coalesce(1)
        parts.append(part.withColumn(number, F.lit(k)) if number else part)
    return reduce(DataFrame.unionByName, parts)


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text lines, one row per line, column ``value`` (``textFile``)."""
    return spark.read.text(path)


def rows(spark: SparkSession, values: Iterable[str], column: str = "value") -> DataFrame:
    """Small in-memory lines (``parallelize``) for fixtures and examples."""
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def read_ip_rules(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``|``-separated IP rule file(s) -> ``lo, hi, province`` (read in parallel)."""
    from skein.functions.records import parse_ip_rules

    return parse_ip_rules(read_lines(spark, path))
