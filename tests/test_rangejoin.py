import pytest
from pyspark.sql import functions as F

from skein.operators import RangeIndex, check_rules, range_lookup, rule_violations

UNKNOWN = "未知"


def rules_df(spark, rules):
    return spark.createDataFrame(rules, "lo bigint, hi bigint, province string")


def lookup_all(spark, rules, numbers, **opts):
    facts = spark.createDataFrame([(n,) for n in numbers], "n bigint")
    out = range_lookup(facts, "n", rules_df(spark, rules), ["province"], {"province": UNKNOWN}, **opts)
    return sorted(((r.n if r.n is not None else -999), r.province) for r in out.collect())


def test_edges_closed_interval(spark):
    rules = [(100, 200, "A"), (300, 400, "B")]
    nums = [100, 200, 250, 5, 1000, 300, None]
    want = sorted([(100, "A"), (200, "A"), (250, UNKNOWN), (5, UNKNOWN), (1000, UNKNOWN), (300, "B"),
                   (-999, UNKNOWN)])
    assert lookup_all(spark, rules, nums) == want


def test_multi_level_wide_rules(spark):
    rules = [(0, 9, "narrow"), (10, 2**40, "wide"), (2**40 + 1, 2**40 + 3, "tiny"), (2**41, 2**50, "huge")]
    nums = [0, 9, 10, 12345678, 2**40, 2**40 + 2, 2**40 + 4, 2**45, 2**50 + 1]
    want = sorted([(0, "narrow"), (9, "narrow"), (10, "wide"), (12345678, "wide"), (2**40, "wide"),
                   (2**40 + 2, "tiny"), (2**40 + 4, UNKNOWN), (2**45, "huge"), (2**50 + 1, UNKNOWN)])
    idx = RangeIndex(rules_df(spark, rules), ["province"], bits=2)
    assert len(idx.sides) > 1
    assert lookup_all(spark, rules, nums, bits=2) == want


def test_shuffled_and_salted_paths(spark):
    rules = [(i * 100, i * 100 + 49, f"r{i}") for i in range(50)]
    nums = list(range(0, 5000, 7)) + [3] * 200
    base = lookup_all(spark, rules, nums)
    assert lookup_all(spark, rules, nums, broadcast_bytes=0) == base
    assert lookup_all(spark, rules, nums, broadcast_bytes=0, salts=4) == base


def test_bucketed_plan_has_no_nested_loop(spark):
    facts = spark.range(0, 1000).withColumnRenamed("id", "n")
    out = range_lookup(facts, "n", rules_df(spark, [(0, 10, "a"), (20, 30, "b")]), ["province"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "HashJoin" in plan


def test_rule_checks(spark):
    assert rule_violations(rules_df(spark, [(1, 10, "a"), (11, 20, "b")])) == {"nulls": 0, "empty": 0, "overlaps": 0}
    assert rule_violations(rules_df(spark, [(1, 10, "a"), (5, 20, "b")]))["overlaps"] > 0
    with pytest.raises(ValueError):
        check_rules(rules_df(spark, [(1, 10, "a"), (5, 20, "b")]))
    with pytest.raises(ValueError):
        check_rules(rules_df(spark, [(10, 1, "a")]))
    # overlap hidden behind a long earlier rule, across many partitions
    many = [(i * 10, i * 10 + 5, str(i)) for i in range(2000)] + [(0, 100000, "long")]
    assert rule_violations(rules_df(spark, many).repartition(9))["overlaps"] > 0


def test_rules_are_checked_by_default(spark):
    for bad in ([(1, 10, "a"), (5, 20, "b")], [(10, 1, "a")], [(None, 5, "a")], [(1, None, "a")]):
        with pytest.raises(ValueError):
            lookup_all(spark, bad, [5])


def test_unchecked_odd_rules_match_nothing(spark):
    rules = [(2**26, 100, "inverted"), (2**40, 100, "inverted"), (None, 7, "open"), (3, None, "open"), (200, 210, "ok")]
    want = sorted([(5, UNKNOWN), (150, UNKNOWN), (205, "ok")])
    assert lookup_all(spark, rules, [5, 150, 205], validate=False) == want
    assert lookup_all(spark, [(None, None, "x")], [1], validate=False) == [(1, UNKNOWN)]


def test_empty_rules_keep_payload_types(spark):
    rules = spark.createDataFrame([], "lo bigint, hi bigint, code int, region string")
    facts = spark.createDataFrame([(1,)], "n bigint")
    out = range_lookup(facts, "n", rules, ["code", "region"])
    assert dict(out.dtypes)["code"] == "int" and out.collect()[0].code is None


def test_wide_payload_is_not_broadcast(spark):
    rules = spark.createDataFrame([(i * 10, i * 10 + 5, "x" * 2000) for i in range(50)], "lo bigint, hi bigint, province string")
    idx = RangeIndex(rules, ["province"], broadcast_bytes=50_000)
    assert not any(small for _, _, small, _ in idx.sides)


def test_salts_follow_the_row(spark):
    """A hot number over many partitions: same rows in any layout."""
    rules = rules_df(spark, [(0, 9, "a"), (10, 19, "b")])
    facts = spark.range(0, 5000).select((F.col("id") % 2 * 10).alias("n"), F.col("id").alias("k"))
    idx = RangeIndex(rules, ["province"], broadcast_bytes=0, salts=8)
    a = idx.lookup(facts.repartition(3), "n").groupBy("n", "province").count().collect()
    b = idx.lookup(facts.repartition(11), "n").groupBy("n", "province").count().collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) == [(0, "a", 2500), (10, "b", 2500)]


ODD_NAMES = ["_lo", "_HI", "_b", "_s", "_ls", "_v0", "_lvl", "_skein_n", "_skein_0_v0", "a.b"]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "salts": 3}])
def test_fact_columns_of_any_name(spark, options):
    rules = rules_df(spark, [(0, 9, "narrow"), (10, 2**40, "wide")])
    facts = spark.range(0, 40).select(F.col("id").alias("n"), *[F.concat(F.lit(c), "id").alias(c) for c in ODD_NAMES])
    out = range_lookup(facts, "n", rules, ["province"], {"province": UNKNOWN}, bits=1, **options)
    assert out.columns == ["n", *ODD_NAMES, "province"]
    for r in out.collect():
        assert r.province == ("narrow" if r.n < 10 else "wide")
        assert [r[c] for c in ODD_NAMES] == [f"{c}{r.n}" for c in ODD_NAMES]


def test_a_payload_clash_raises_unless_renamed(spark):
    index = RangeIndex(rules_df(spark, [(0, 9, "a")]), ["province"])
    facts = spark.createDataFrame([(3, "mine"), (30, "mine")], "n bigint, Province string")
    with pytest.raises(ValueError, match="province"):
        index.lookup(facts, "n")
    out = index.lookup(facts, "n", {"province": UNKNOWN}, names={"province": "found"})
    assert sorted(map(tuple, out.collect())) == [(3, "mine", "a"), (30, "mine", UNKNOWN)]


def test_the_rule_check_of_many_rules_is_distributed(spark, monkeypatch):
    from skein.operators import rangejoin

    monkeypatch.setattr(rangejoin, "FEW_RULES", 0)
    many = [(i * 10, i * 10 + 5, str(i)) for i in range(2000)]
    assert rule_violations(rules_df(spark, many).repartition(9))["overlaps"] == 0
    assert rule_violations(rules_df(spark, [*many, (0, 100000, "long")]).repartition(9))["overlaps"] > 0
    plan = []
    monkeypatch.setattr(rangejoin.DataFrame, "mapInPandas", lambda *a, **k: plan.append(1), raising=False)
    rule_violations(rules_df(spark, many))
    assert not plan


OVERLAPPING = [(0, 9, "a"), (5, 20, "b"), (5, 20, "b"), (7, 7, "c"), (21, 30, "d"), (40, 2**40, "wide"), (1000, 1003, "e"),
               (90_000, 90_004, "f"), (2**45, 2**50, "huge"), (-50, -40, "g"), (1002, 1010, None)]


@pytest.mark.parametrize("opts", [{}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "salts": 3}, {"bits": 2, "max_span": 4}])
@pytest.mark.parametrize("few", [True, False])
def test_overlapping_rules_give_a_row_each(spark, monkeypatch, opts, few):
    if not few:
        monkeypatch.setattr("skein.operators.rangejoin.FEW_RULES", 0)
    nums = [*range(-60, 60), 999, 1000, 1002, 1003, 1004, 1010, 1011, 89_999, 90_004, 2**40, 2**40 + 1, 2**44, 2**45, 2**50,
            2**50 + 1, 2**62, -2**63, 2**63 - 1, 7, 7, None]
    want = []
    for n in nums:
        held = [] if n is None else [p or UNKNOWN for lo, hi, p in OVERLAPPING if lo <= n <= hi]
        want += [(-999 if n is None else n, p) for p in held or [UNKNOWN]]
    assert lookup_all(spark, OVERLAPPING, nums, overlapping=True, **opts) == sorted(want)


def test_overlapping_allowed_but_absent_or_wrong(spark):
    assert lookup_all(spark, [(1, 5, "a")], [0, 1, None], overlapping=True) == [(-999, UNKNOWN), (0, UNKNOWN), (1, "a")]
    with pytest.raises(ValueError):
        lookup_all(spark, [(1, 5, "a"), (3, 2, "b")], [1], overlapping=True)
    odd = [(1, 5, "a"), (4, 6, "b"), (9, 8, "c"), (None, 9, "d")]
    assert lookup_all(spark, odd, [5, 8], overlapping=True, validate=False) == [(5, "a"), (5, "b"), (8, UNKNOWN)]


def test_multilevel_query_with_large_customer_keys(spark, tmp_path):
    import duckdb

    from skein.plans import all_oracles, all_queries
    from tests.conftest import SF001

    con = duckdb.connect()
    shift = "(SELECT unnest([0, 262000, 300000, 899000]) AS k)"
    for name, rows in (("nation", "SELECT * FROM t"),
                       ("customer", f"SELECT * REPLACE (c_custkey + k AS c_custkey) FROM t, {shift}"),
                       ("orders", f"SELECT * REPLACE (o_custkey + k AS o_custkey) FROM t, {shift}")):
        con.sql(f"COPY (WITH t AS (FROM '{SF001}/{name}.parquet') {rows}) TO '{tmp_path}/{name}.parquet'")
        con.sql(f"CREATE VIEW {name} AS FROM '{tmp_path}/{name}.parquet'")
    want = sorted(con.sql(all_oracles()["ip_region_lookup_multilevel"]).fetchall())
    assert len(want) > con.sql("SELECT count(*) FROM orders").fetchall()[0][0]  # some numbers have two rules
    found = all_queries()["ip_region_lookup_multilevel"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == want
