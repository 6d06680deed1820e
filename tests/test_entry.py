import duckdb
import pytest

import __spark_entry__ as entry
from skein.plans import all_queries
from tests.conftest import SF001
from tools.oracle_check import TABLES, normalise


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["subject", "teacher", "cnt", "rn"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from skein.plans import all_oracles

    assert set(all_queries()) == set(all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


BATCH = list(all_queries())


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle_sf0001(spark, duck, name):
    df = entry.queries()[name](spark, SF001)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    oorder = sorted(range(len(ocols)), key=lambda i: ocols[i])
    assert normalise([tuple(r[i] for i in order) for r in rows]) == normalise(
        [tuple(r[i] for i in oorder) for r in orows])


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_read_only_needed_columns(spark):
    from skein.plans import catalog

    assert "ReadSchema: struct<url:string>" in _plan(catalog.topn_per_group(spark, SF001))
    wc = _plan(catalog.word_count(spark, SF001))
    assert "ReadSchema: struct<text:string>" in wc
    inc = _plan(catalog.income_by_item(spark, SF001))
    assert "o_orderdate" not in inc and "o_orderpriority" not in inc


def test_region_lookup_is_a_hash_join(spark):
    from skein.plans import catalog

    plan = _plan(catalog.income_by_region(spark, SF001))
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan
