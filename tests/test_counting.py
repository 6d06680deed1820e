from pyspark.sql import functions as F

from skein.operators import count_by, field_stats, grand_total, sum_by
from skein.sources.files import rows


def test_count_by_and_sum(spark):
    df = rows(spark, ["a", "b", "a"], "word")
    assert sorted(map(tuple, count_by(df, "word").collect())) == [("a", 2), ("b", 1)]
    assert dict(count_by(df, "word").dtypes)["cnt"] == "bigint"
    prices = spark.createDataFrame([("x", 1.5), ("y", 2.0), ("x", 3.0)], "item string, price double")
    assert sorted(map(tuple, sum_by(prices, "item", "price", "s").collect())) == [("x", 4.5), ("y", 2.0)]
    assert grand_total(prices, "price", "t").first()["t"] == 6.5


def test_field_stats_two_decimals(spark):
    df = spark.createDataFrame([(1,), (2,), (2,)], "size int")
    r = field_stats(df, "size").first()
    assert (r.max_value, r.min_value, r.avg_value) == (2, 1, "1.67")


def test_field_stats_empty_gives_no_row(spark):
    df = spark.createDataFrame([], "size int")
    assert field_stats(df, "size").count() == 0


def test_partial_aggregation_in_plan(spark):
    df = rows(spark, ["a"] * 10, "word")
    plan = count_by(df, "word")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_max_min_only(spark):
    df = spark.createDataFrame([(1,), (5,)], "size int")
    out = field_stats(df, "size", with_avg=False)
    assert out.columns == ["max_value", "min_value"] and tuple(out.first()) == (5, 1)


def test_combine_by_key_with_a_hot_key(spark):
    import pandas as pd

    from skein.operators import combine_by_key

    df = spark.range(0, 2000).selectExpr("IF(id % 3 > 0, 'hot', concat('k', id % 4)) AS k", "id AS v")
    create = lambda p: p.groupby("k", sort=False)["v"].agg(s="sum", n="size").astype("int64").reset_index()
    merge = lambda p: pd.DataFrame({"k": [p["k"].iloc[0]], "s": [p["s"].sum()], "n": [p["n"].sum()]})
    got = sorted(map(tuple, combine_by_key(df.repartition(7), "k", create, merge, "k string, s bigint, n bigint").collect()))
    assert got == sorted(map(tuple, df.groupBy("k").agg({"v": "sum", "k": "count"}).selectExpr("k", "`sum(v)`", "`count(k)`").collect()))
