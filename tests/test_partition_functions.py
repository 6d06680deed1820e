import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skein.operators import combine_by_key, combine_placed, map_partitions, top_n_batches, top_n_per_group
from tests.conftest import SF001

RULE = [("cnt", "desc"), ("name", "asc")]
OUT = "g string, name string, cnt bigint, rn bigint"


def _counts(spark, n=400):
    rows = [(None if k % 7 == 0 else f"g{k % 5}", f"n{k % 37}", None if k % 11 == 0 else k % 13) for k in range(n)]
    return spark.createDataFrame(rows, "g string, name string, cnt bigint").dropDuplicates(["g", "name"])


@pytest.mark.parametrize("one_key_each", [False, True])
@pytest.mark.parametrize("batch_rows", ["1", "3", "10000"])
def test_top_n_function_equals_the_window(spark, one_key_each, batch_rows):
    df = _counts(spark)
    want = sorted(map(tuple, top_n_per_group(df, "g", 4, RULE).collect()), key=repr)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        got = map_partitions(df, top_n_batches("g", 4, RULE), OUT, key="g", one_key_each=one_key_each).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=repr) == want


def test_each_partition_holds_one_key_in_order(spark):
    def look(batches):
        seen, order = [], []
        for b in batches:
            seen += b.column("g").to_pylist()
            order += b.column("cnt").to_pylist()
        yield pa.RecordBatch.from_pydict({"keys": [len(set(seen))], "sorted": [order == sorted(order)], "n": [len(seen)]})

    df = _counts(spark).where("cnt is not null")
    got = map_partitions(df, look, "keys bigint, sorted boolean, n bigint", key="g", rule=["cnt"], one_key_each=True).collect()
    assert len(got) == 6 and all(r.keys == 1 and r.sorted for r in got) and sum(r.n for r in got) == df.count()


def test_a_partition_streams_through_in_batches(spark):
    def count(batches):
        longest = n = 0
        for b in batches:
            longest, n = max(longest, b.num_rows), n + b.num_rows
        yield pa.RecordBatch.from_pydict({"longest": [longest], "n": [n]})

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        got = map_partitions(spark.range(50_000).withColumn("g", F.lit("one")), count, "longest bigint, n bigint", key="g").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert max(r.n for r in got) == 50_000 and max(r.longest for r in got) <= 100


def test_without_key_and_empty(spark):
    def same(batches):
        yield from batches

    assert map_partitions(spark.range(10), same, "id bigint").count() == 10
    assert map_partitions(_counts(spark).limit(0), top_n_batches("g", 3, RULE), OUT, key="g").count() == 0
    with pytest.raises(ValueError):
        map_partitions(_counts(spark), same, "g string, name string, cnt bigint", key="g", one_key_each=True, max_partitions=2)


def test_the_query_reads_its_input_once(spark):
    from skein.plans import catalog

    plan = catalog.topn_partition_function(spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "pages.parquet" not in plan and plan.count("placed-") >= 1


def _functions():
    # Local functions are pickled whole: workers don't import this module.
    def create(rows):
        return rows.groupby("k", dropna=False, sort=False).agg(total=("v", "sum"), n=("v", "size")).reset_index()

    def merge(states):
        return states.groupby("k", dropna=False, sort=False).agg({"total": "sum", "n": "sum"}).reset_index()

    return create, merge


STATE = "k bigint, total bigint, n bigint"


@pytest.mark.parametrize("hold", [1, 50, 100_000])
def test_placed_combiner_equals_built_ins(spark, hold):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 == 0, F.lit(None)).otherwise(F.col("id") % 999).alias("k"),
        F.col("id").alias("v"))
    want = sorted(map(tuple, df.groupBy("k").agg(F.sum("v"), F.count(F.lit(1))).collect()), key=repr)
    create, merge = _functions()
    got = combine_placed(df, "k", create, merge, STATE, hold=hold, place_by=F.col("k") % 4)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    placed = got.withColumn("p", F.spark_partition_id()).groupBy(F.expr("k % 4").alias("c")).agg(F.countDistinct("p").alias("n"))
    assert all(r.n == 1 for r in placed.collect())


def test_merge_values_is_used(spark):
    create, merge = _functions()

    def add(states, rows):
        return merge(pd.concat([states, create(rows)], ignore_index=True))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = combine_placed(spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")), "k", create,
                             merge, STATE, merge_values=add).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(r.n for r in got) == [166, 167, 167]


def test_a_million_keys_are_held_in_bounded_memory(spark):
    import resource

    first, _ = _functions()

    def create(rows):
        out = first(rows)
        return out.assign(n=resource.getrusage(resource.RUSAGE_SELF).ru_maxrss)

    def merge(states):
        return states.groupby("k", dropna=False, sort=False).agg({"total": "sum", "n": "max"}).reset_index()

    df = spark.range(0, 1_000_000, 1, 1).select(F.col("id").alias("k"), F.col("id").alias("v"))
    got = combine_placed(df, "k", create, merge, STATE, hold=20_000)
    row = got.agg(F.count(F.lit(1)).alias("keys"), F.max("n").alias("kb")).first()
    assert row.keys == 1_000_000 and row.kb < 700_000


def test_combine_by_key_with_a_merge_for_one_key(spark):
    def merge(states):
        return pd.DataFrame({"k": [states["k"].iloc[0]], "total": [states["total"].sum()], "n": [states["n"].sum()]})

    create, _ = _functions()
    df = spark.range(5000).select((F.col("id") % 11).alias("k"), F.col("id").alias("v"))
    got = sorted(map(tuple, combine_by_key(df, "k", create, merge, STATE).collect()))
    assert got == sorted(map(tuple, df.groupBy("k").agg(F.sum("v"), F.count(F.lit(1))).collect()))
