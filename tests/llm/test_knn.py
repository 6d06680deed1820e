import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skein.llm.op8_voronoi_knn import OP8_SQL, knn_join, op8_voronoi_knn, scores
from tests.conftest import SF001

SCHEMA = "vec_id bigint, embedding array<double>, cell int, q string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)


def brute(rows, k, step):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            ok.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = set()
    for i, vs in ok.items():
        if i % step == 0:
            best = {}
            for q in vs:
                for j, ws in ok.items():
                    if j != i:
                        s = max(sum(a * b for a, b in zip(q, w)) for w in ws)
                        best[j] = max(best.get(j, s), s)
            for rank, (s, j) in enumerate(sorted((-s, j) for j, s in best.items())[:k], 1):
                out.add((i, rank, j, -s))
    return out


def got(spark, rows, k=5, step=10, **options):
    df = knn_join(table(spark, rows), F.col("vec_id") % step == 0, k=k, **options)
    out = [(r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()]
    assert len(out) == len(set(out))
    return set(out)


@pytest.fixture(scope="module")
def cloud():
    r = np.random.default_rng(3)
    centres = r.normal(size=(6, 8)) * 2
    return [(i, [float(x) for x in centres[i % 6] + r.normal(size=8) * 0.3]) for i in range(700)]


def test_equals_brute_force(spark, cloud):
    assert got(spark, cloud) == brute(cloud, 5, 10)


def test_ties_copies_and_odd_vectors(spark, cloud):
    rows = cloud[:150] + [(1000 + i, cloud[0][1]) for i in range(200)]  # a hot vector: only ties
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 6), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7),
             (2004, [1.0, 2.0]), (2010, [0.0] * 8), (2011, []), (None, cloud[1][1]), (30, cloud[30][1])]
    assert got(spark, rows) == brute(rows, 5, 10)
    assert got(spark, rows, max_pivots=1, query_block=7) == brute(rows, 5, 10)


def test_few_or_no_candidates(spark):
    assert got(spark, []) == set()
    assert got(spark, [(10, [1.0])]) == set()
    assert got(spark, [(10, [1.0]), (3, [2.0])]) == {(10, 1, 3, 256 * 512)}


def test_large_components_stay_exact():
    q, x = np.array([[2 ** 40, 1]]), np.array([[2 ** 20, 3]])
    assert scores(q, x)[0, 0] == 2 ** 60 + 3


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    want = {(r[0], r[1], r[2], r[3]) for r in con.execute(f"SELECT query_id, rank, vec_id, score FROM ({OP8_SQL})").fetchall()}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in op8_voronoi_knn(spark, SF001).collect()} == want
