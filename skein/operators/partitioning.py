"""Placement of rows by key, and a caller's function per partition.

``repartition(col)`` hashes, so two keys can share a partition.  To give each
distinct key its own partition, keys get dense ids ``0..k-1`` and rows are
placed with ``repartitionById``.  The distinct keys are counted first; more
than ``max_partitions`` of them are refused, which bounds the id table (one
row per key), its broadcast and its numbering.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skein.operators.ranking import SortRule, order_columns
from skein.session import written

Batches = Iterator[pa.RecordBatch]


def key_ids(keys: DataFrame, key: str, max_keys: int, id_col: str = "_skein_pid") -> tuple[DataFrame, int]:
    """Distinct ``key`` values with dense ids from 0 in key order (NULL first), and their number."""
    distinct = written(keys.select(F.col(key).alias("_skein_key")).distinct(), "keys")
    k = distinct.count()
    if k > max_keys:
        raise ValueError(f"{k} distinct keys exceed max_partitions={max_keys}")
    order = Window.orderBy(F.col("_skein_key").asc_nulls_first())
    return distinct.select("_skein_key", (F.row_number().over(order) - 1).alias(id_col)), k


def partition_per_key(df: DataFrame, key: str, max_partitions: int = 4096,
                      keys_from: DataFrame | None = None) -> DataFrame:
    """Repartition so that every partition holds rows of exactly one ``key`` value.

    Raises ``ValueError`` when there are more than ``max_partitions`` keys.
    ``keys_from`` may name a cheaper DataFrame with the same key values; without
    it ``df`` is read twice (for its keys, and to be placed).
    """
    ids, k = key_ids(df if keys_from is None else keys_from, key, max_partitions)
    if k == 0:
        return df
    placed = df.join(F.broadcast(ids), df[key].eqNullSafe(ids["_skein_key"]))
    return placed.repartitionById(int(k), "_skein_pid").drop("_skein_key", "_skein_pid")


def map_partitions(df: DataFrame, fn: Callable[[Batches], Batches], schema: str, key: str | None = None,
                   rule: SortRule = (), one_key_each: bool = False, max_partitions: int = 4096) -> DataFrame:
    """``mapPartitions`` with a caller's function over Arrow batches.

    With ``key`` rows are placed by it first - all rows of a key in one partition, in
    ``one_key_each`` mode one key value per partition (at most ``max_partitions``) - and
    each partition is sorted by key and then by ``rule``.  ``fn`` reads its partition
    once, batch by batch, and may yield as it goes: what it holds is up to it, so a
    partition is never one object.  The input is read once; in ``one_key_each`` mode it
    is written to the shared scratch folder and its keys are taken from there.

    A partition without rows calls ``fn`` with no batch.
    """
    if key is None:
        return (df.sortWithinPartitions(*order_columns(rule)) if rule else df).mapInArrow(fn, schema)
    if one_key_each:
        stored = written(df, "placed")
        placed = partition_per_key(stored, key, max_partitions)
    else:
        placed = df.repartition(F.col(key))
    return placed.sortWithinPartitions(F.col(key), *order_columns(rule)).mapInArrow(fn, schema)


def top_n_batches(key: str, n: int, rule: SortRule, rn: str = "rn") -> Callable[[Batches], Batches]:
    """A function for :func:`map_partitions`: the first ``n`` rows of every key in ``rule`` order.

    The partition must be sorted by ``key``; within a key any order will do.  It holds at
    most ``n`` rows and one batch.  NULLs sort as in Spark: first ascending, last
    descending.
    """
    items = [(i, "asc") if isinstance(i, str) else i for i in rule]

    def first_n(rows: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray]:
        """Rows with rank < n in their run of equal keys, their runs and ranks."""
        codes = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        run = np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])]) if len(codes) else codes
        by, sort = {"run": pa.array(run)}, [("run", "ascending")]
        for k, (name, direction) in enumerate(items):
            order = "descending" if direction.lower() == "desc" else "ascending"
            by |= {f"v{k}": pc.is_valid(rows.column(name)), f"c{k}": rows.column(name)}
            sort += [(f"v{k}", order), (f"c{k}", order)]
        at = pc.sort_indices(pa.table(by), sort_keys=sort).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else run
        rank = np.arange(len(run)) - np.repeat(starts, np.diff(np.append(starts, len(run))))
        keep = rank < n
        return rows.take(at[keep]), run[keep], rank[keep]

    def ranked(rows: pa.Table, rank: np.ndarray) -> Batches:
        out = rows.append_column(rn, pa.array(rank + 1, pa.int64()))
        yield from out.combine_chunks().to_batches()

    def run(batches: Batches) -> Batches:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = pa.Table.from_batches([batch])
            rows, of, rank = first_n(new if held is None else pa.concat_tables([held, new]))
            done = int(np.searchsorted(of, of[-1]))
            yield from ranked(rows.slice(0, done), rank[:done])
            held = rows.slice(done)
        if held is not None:
            yield from ranked(held, np.arange(held.num_rows))

    return run
