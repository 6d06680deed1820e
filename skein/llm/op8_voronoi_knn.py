"""Exact top-k by inner product as a Voronoi kNN join.

Pivots split space into cells; every vector belongs to its nearest pivot.  For
each cell a summary holds its pivot p, its number of vectors and its radius U
(the largest distance of a vector to the pivot).  With q.x = q.p + q.(x - p),
no vector of the cell scores above ``q.p + |q| U`` for a query q.

1. Every query is solved exactly inside its own cell; its k-th score there is a
   lower bound of what it needs.
2. A query is replicated only to the other cells whose bound reaches its lower
   bound, and solved locally there; rows below the lower bound aren't returned.
3. The local lists of a query (at most k rows each) are merged.

Queries are the small side, so they are what is replicated; the vectors are dealt
by cell and stay.  A cell with many vectors (a hot pivot, copies of one vector)
is split by a hash of the id into blocks of at most about ``block`` vectors, and
the queries of a block come in blocks of ``query_block``, so that no task holds
an unbounded group.  The pivots are a seeded sample bounded by ``max_pivots``;
they decide speed only, every vector is in a cell.

Defined results
* vectors that are null, or hold a null or non-finite component, take no part;
* components become floor(256 x); shorter vectors count as filled up with zeros;
* ties go to the smaller vec_id; rows of one vec_id are one candidate, with
  its best score, and none is a candidate of its own query;
* fewer candidates than k: all of them; none, or an empty table: no rows;
* a null vec_id takes no part; other input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skein.llm.common import cut, slices, table

SCALE = 256.0
#: Scores below this are exact sums of products in double precision.
EXACT = 2.0 ** 53
FOUND = "query_id bigint, vec_id bigint, score bigint"


def _quantize(scale: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            ids, out = [], []
            for vec_id, v in zip(part.column(0).to_pylist(), part.column(1)):
                if not v.is_valid or v.values.null_count or vec_id is None:
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(x).all():
                    ids.append(vec_id)
                    out.append(np.floor(scale * x).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "v"])

    return run


def _matrix(blobs, dim: int) -> np.ndarray:
    """Rows of int64 components, filled up with zeros to ``dim``."""
    out = np.zeros((len(blobs), dim), dtype=np.int64)
    for k, b in enumerate(blobs):
        out[k, :len(b) // 8] = np.frombuffer(b, dtype=np.int64)
    return out


def nearest_pivot(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, distance) of each row; the first of equally near pivots."""
    x = x.astype(np.float64)
    square = (pivots ** 2).sum(1) - 2 * x @ pivots.T
    cell = square.argmin(1)
    return cell, np.sqrt(((x - pivots[cell]) ** 2).sum(1))


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products: by doubles where these are exact, else by integers."""
    if len(q) and len(x) and float(np.abs(q).max()) * float(np.abs(x).max()) * q.shape[1] < EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def solve(queries: pd.DataFrame, data: pd.DataFrame, dim: int, k: int, rows: int = 128) -> pd.DataFrame:
    """Best k of ``data`` for each query, none below its ``least`` (null: no bound)."""
    out = []
    # The rows of a cell in order of their ids: ties then go to the first column.
    data = data.drop_duplicates(["vec_id", "v"]).sort_values("vec_id")
    ids, x = data["vec_id"].to_numpy(), _matrix(data["v"], dim)
    queries = queries.drop_duplicates(["vec_id", "v"])
    want = min(len(ids), k + 1 + len(ids) - len(np.unique(ids)))
    for at in range(0, len(queries) if len(ids) else 0, rows):
        part = queries.iloc[at:at + rows]
        own = part["vec_id"].to_numpy()
        s = scores(_matrix(part["v"], dim), x)
        least = part["least"].to_numpy()
        edge = np.maximum(np.partition(s, len(ids) - want, axis=1)[:, len(ids) - want], least)
        i, j = np.nonzero((s >= edge[:, None]) & (own[:, None] != ids[None, :]))
        found = pd.DataFrame({"query_id": own[i], "vec_id": ids[j], "score": s[i, j]})
        found = found.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        found = found.drop_duplicates(["query_id", "vec_id"])
        out.append(found.groupby("query_id").head(k))
    return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})


def knn_join(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = SCALE, max_pivots: int = 256,
             query_block: int = 4096, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all vectors for those with ``is_query``.

    ``vectors`` has vec_id and embedding (array of numbers); ``is_query`` is a
    condition on vec_id.
    """
    spark = vectors.sparkSession
    least_long = -(2 ** 63) + 1
    v = cut(vectors.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(
        _quantize(scale), "vec_id bigint, v binary"), "knn-vectors")
    n, width = v.agg(F.count(F.lit(1)), F.max(F.length("v"))).first()
    dim = max(1, (width or 0) // 8)
    n_pivots = max(1, min(max_pivots, int(n ** 0.5)))
    sample = v.orderBy(F.xxhash64(F.lit(seed), "vec_id"), "vec_id").limit(4 * n_pivots).select("v").collect()
    pivots = np.unique(_matrix([r["v"] for r in sample], dim), axis=0)
    if len(pivots) > n_pivots:
        pivots = pivots[np.sort(np.random.default_rng(seed).choice(len(pivots), n_pivots, replace=False))]
    pivots = pivots.astype(np.float64)
    shared = spark.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 4096):
            if part.num_rows:
                cell, d = nearest_pivot(_matrix(part.column(1).to_pylist(), dim), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell.astype(np.int32)), pa.array(d)], ["vec_id", "v", "cell", "distance"])

    cells = cut(v.mapInArrow(assign, "vec_id bigint, v binary, cell int, distance double"), "knn-cells")
    summary = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).collect()
    block = min(8192, max(512, n // 64))
    splits = np.ones(len(pivots) + 1, dtype=np.int64)
    radius = np.full(len(pivots), -1.0)
    for r in summary:
        splits[r["cell"]] = -(-r["n"] // block)
        radius[r["cell"]] = r["radius"] * (1 + 1e-9) + 1e-6

    of_cell = F.element_at(F.array(*[F.lit(int(s)) for s in splits]), F.col("cell") + 1)
    data = cells.select("cell", F.pmod(F.xxhash64("vec_id"), of_cell).alias("split"), "vec_id", "v")
    queries = cells.where(is_query).select("vec_id", "v", "cell")
    q_blocks = max(1, -(-queries.count() // query_block))
    bounds = spark.sparkContext.broadcast((pivots, radius, splits))

    def dealt(q: DataFrame, others: bool) -> DataFrame:
        """Queries to their own cell, or to each other cell whose bound reaches ``least``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pivots, radius, splits = bounds.value
            for part in slices(batches, 512):
                ids, blobs, own, least = (c.to_numpy(zero_copy_only=False) for c in part.columns)
                if others:
                    m = _matrix(blobs, dim).astype(np.float64)
                    top = m @ pivots.T + np.sqrt((m ** 2).sum(1))[:, None] * radius[None, :]
                    need = (top * (1 + 1e-12) + 1e-3 >= least[:, None].astype(np.float64)) & (radius >= 0)[None, :]
                    need[np.arange(len(own)), own] = False
                    i, cell = np.nonzero(need)
                else:
                    i, cell = np.arange(len(own)), own
                times = splits[cell]
                i, cell = np.repeat(i, times), np.repeat(cell, times)
                split = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
                for at in range(0, len(i), 8192):
                    s = slice(at, at + 8192)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[s].astype(np.int32)), pa.array(split[s].astype(np.int64)), pa.array(ids[i[s]]),
                         pa.array(blobs[i[s]], pa.binary()), pa.array(least[i[s]])],
                        ["cell", "split", "vec_id", "v", "least"])

        return q.select("vec_id", "v", "cell", "least").mapInArrow(
            run, "cell int, split bigint, vec_id bigint, v binary, least bigint").withColumn(
            "q", F.pmod(F.xxhash64("vec_id"), F.lit(q_blocks)))

    def local(q: DataFrame) -> DataFrame:
        """Meet queries and vectors block by block; vectors go to each block of queries their cell has."""
        keys = ["cell", "split", "q"]
        q = cut(q, "knn-dealt")
        blocks = q.select(*[F.col(c).alias(c) for c in keys]).distinct()
        d = data.join(blocks, ["cell", "split"])
        return q.groupBy(keys).cogroup(d.groupBy(keys)).applyInPandas(
            lambda a, b: solve(a, b, dim, k), FOUND)

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def top(found: DataFrame) -> DataFrame:
        one = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return one.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    first = cut(top(local(dealt(queries.withColumn("least", F.lit(least_long)), False))), "knn-own")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))
    open_q = queries.join(kth, "vec_id", "left").withColumn("least", F.coalesce("least", F.lit(least_long)))
    more = local(dealt(open_q, True))
    return top(first.select("query_id", "vec_id", "score").unionByName(more)).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five best vectors of all for every vector whose id is divisible by 50."""
    return knn_join(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
