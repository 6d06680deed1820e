"""Counts, sums and field statistics.

Every aggregate here is an algebraic built-in, so Spark plans a partial
(map-side) aggregate before the shuffle: a key that holds a third of all rows
is reduced to one row per map task before it moves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skein.functions.text import fixed2

KeyList = str | Column | Sequence[str | Column]


def _keys(keys: KeyList) -> list:
    if isinstance(keys, (str, Column)):
        return [keys]
    return list(keys)


def count_by(df: DataFrame, keys: KeyList, name: str = "cnt", partition_by: str | None = None) -> DataFrame:
    """Rows per key (``map((_, 1)).reduceByKey(_+_)``); counts are BIGINT.

    ``partition_by`` (a subset of the keys) places the counts by that column
    (``reduceByKey(partitioner, f)``): rows are combined per map task and per
    key first, so only one row per key moves to its place, and a later window
    on the same column needs no further exchange.
    """
    counts = df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))
    return counts if partition_by is None else counts.repartition(partition_by)


def sum_by(df: DataFrame, keys: KeyList, value: str, name: str) -> DataFrame:
    """Sum of ``value`` per key (``reduceByKey(_+_)``)."""
    return df.groupBy(*_keys(keys)).agg(F.sum(value).alias(name))


def grand_total(df: DataFrame, value: str, name: str) -> DataFrame:
    """One-row sum of ``value`` (NULL on empty input; guard batches upstream)."""
    return df.agg(F.sum(value).alias(name))


def field_stats(df: DataFrame, value: str, with_avg: bool = True) -> DataFrame:
    """``max``, ``min`` and the mean as text with two decimals.

    Grouped by a constant key, so empty input gives no row at all (a global
    aggregate would give one row of NULLs).
    """
    aggs = [F.max(value).alias("max_value"), F.min(value).alias("min_value")]
    if with_avg:
        aggs.append(fixed2(F.sum(value).cast("double") / F.count(value)).alias("avg_value"))
    return df.groupBy(F.lit("key").alias("key")).agg(*aggs).drop("key")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``key``."""
    return df.select(key).distinct()


Frames = Iterator[pd.DataFrame]
Combiner = Callable[[pd.DataFrame], pd.DataFrame]


def _same_key(rows: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """Which rows have the keys of the last one (NULLs are equal)."""
    same = np.ones(len(rows), bool)
    for k in keys:
        last = rows[k].iloc[-1]
        same &= rows[k].isna().to_numpy() if pd.isna(last) else (rows[k] == last).fillna(False).to_numpy(bool)
    return same


def _merge_sorted(merge: Combiner, keys: list[str]) -> Callable[[Frames], Frames]:
    """Merge state rows sorted by key; holds one batch and the state of the key still open."""

    def run(batches: Frames) -> Frames:
        held: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty:
                continue
            rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
            open_ = _same_key(rows, keys)
            if not open_.all():
                yield merge(rows[~open_].reset_index(drop=True))
            held = merge(rows[open_].reset_index(drop=True))
        if held is not None:
            yield held

    return run


def combine_placed(
    df: DataFrame,
    key: str | Sequence[str],
    create: Combiner,
    merge: Combiner,
    schema: str,
    merge_values: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame] | None = None,
    place_by: str | Column | None = None,
    hold: int = 100_000,
    fan_in: int = 64,
) -> DataFrame:
    """``combineByKey(createCombiner, mergeValue, mergeCombiners, partitioner)`` over frames.

    All functions take and give frames that hold many keys, one call for all of them:

    * ``create(rows)``: a state row per key of the rows;
    * ``merge_values(states, rows)``: the states after the rows came to them, a row per key
      of either (default: ``merge`` of the states and ``create(rows)``);
    * ``merge(states)``: any number of state rows per key to one each.

    A map task holds at most ``hold`` state rows beside a batch and hands them over
    when more keys than that have come, so its memory does not grow with the number of keys.
    The states of a key meet in up to ``fan_in`` places first, sorted by key and merged
    as they stream by, then where ``place_by`` (a column, default the key) puts
    them: the result is partitioned by it.  ``place_by`` must be the same for all states
    of a key (made from the key's columns).
    """
    keys = [key] if isinstance(key, str) else list(key)

    def per_task(batches: Frames) -> Frames:
        held: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty:
                continue
            if held is None:
                held = create(batch)
            elif merge_values is not None:
                held = merge_values(held, batch)
            else:
                held = merge(pd.concat([held, create(batch)], ignore_index=True))
            if len(held) > hold:
                yield held
                held = None
        if held is not None:
            yield held

    together = _merge_sorted(merge, keys)
    states = df.mapInPandas(per_task, schema).withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    met = states.repartition(*keys, "_salt").sortWithinPartitions(*keys).drop("_salt").mapInPandas(together, schema)
    place = [place_by] if place_by is not None else keys
    return met.repartition(*place).sortWithinPartitions(*keys).mapInPandas(together, schema)


def combine_by_key(
    df: DataFrame,
    key: str,
    create: Combiner,
    merge: Combiner,
    schema: str,
    fan_in: int = 64,
) -> DataFrame:
    """:func:`combine_placed` for a ``merge`` that takes the state rows of one key.

    ``create`` turns a batch of rows into one state row per key of the batch; ``schema``
    is the state row's, ``key`` included.  ``merge`` is called only for keys with
    more than one state.
    """

    def merge_all(states: pd.DataFrame) -> pd.DataFrame:
        several = states.duplicated(key, keep=False)
        if not several.any():
            return states
        more = [merge(g) for _, g in states[several].groupby(key, dropna=False, sort=False)]
        return pd.concat([states[~several], *more], ignore_index=True)

    return combine_placed(df, key, create, merge_all, schema, fan_in=fan_in)
