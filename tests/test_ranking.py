import pytest
from pyspark.sql import functions as F

from skein.functions import parse_users, subject_teacher
from skein.operators import (
    count_by,
    partition_per_key,
    position_in_ranges,
    sort_by_rule,
    top_counts_all_keys,
    top_n,
    top_n_distinct_counts,
    top_n_per_group,
    with_position,
)
from skein.sources.files import rows

USERS = ["ann 30 99", "bob 29 9999", "cid 28 98", "dan 28 99"]
RULE = [("fv", "desc"), ("age", "asc")]


def test_custom_sort_rule(spark):
    u = parse_users(rows(spark, USERS))
    assert [r.name for r in sort_by_rule(u, RULE).collect()] == ["bob", "dan", "ann", "cid"]


def test_with_position_matches_local_sort(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id"))
    pos = with_position(df.repartition(7), [("k", "desc"), ("id", "asc")], "pos")
    got = sorted((r.pos, r.k) for r in pos.collect())
    assert [p for p, _ in got] == list(range(1, 5001))
    assert [k for _, k in got] == sorted((r.k for r in df.collect()), reverse=True)


def test_top_n_whole_table_plan(spark):
    df = spark.range(100).withColumnRenamed("id", "cnt")
    t = top_n(df, 3, [("cnt", "desc")])
    assert [r.cnt for r in t.collect()] == [99, 98, 97]
    assert "TakeOrderedAndProject" in t._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def subject_counts(spark):
    from tests.conftest import SF001
    from skein.plans.inputs import access_log

    return count_by(access_log(spark, SF001).select(*subject_teacher("value")), ["subject", "teacher"])


def _rows(df):
    return sorted((r.subject, r.teacher, r.cnt, r.rn) for r in df.collect())


def test_topn_strategies_agree(spark, subject_counts):
    rule = [("cnt", "desc"), ("teacher", "asc")]
    w = top_n_per_group(subject_counts, "subject", 3, rule)
    k = top_n_per_group(subject_counts, "subject", 3, rule, strategy="key_partitions")
    assert _rows(w) == _rows(k)
    groups = sorted({r.subject for r in subject_counts.select("subject").distinct().collect()})[:3]
    listed = top_n_per_group(subject_counts, "subject", 3, rule, strategy="listed", groups=groups)
    wl = top_n_per_group(subject_counts, "subject", 3, rule, groups=groups)
    assert _rows(listed) == _rows(wl) and len(_rows(listed)) > 0


def test_topn_window_uses_group_limit(spark, subject_counts):
    w = top_n_per_group(subject_counts, "subject", 3, [("cnt", "desc"), ("teacher", "asc")])
    plan = w._jdf.queryExecution().executedPlan().toString()
    w.collect()
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_topn_hot_group_small_batches(spark):
    # one group holds most rows; batches are tiny so groups straddle Arrow batches
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = spark.range(0, 3000).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), (F.col("id") % 5).cast("string"))).alias("subject"),
            F.col("id").cast("string").alias("teacher"),
            (F.col("id") % 13).alias("cnt"),
        )
        rule = [("cnt", "desc"), ("teacher", "asc")]
        a = top_n_per_group(df, "subject", 4, rule)
        b = top_n_per_group(df, "subject", 4, rule, strategy="key_partitions")
        assert _rows(a) == _rows(b)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_partition_per_key_one_key_each(spark):
    df = spark.range(0, 500).select((F.col("id") % 6).cast("string").alias("k"), "id")
    placed = partition_per_key(df, "k").withColumn("p", F.spark_partition_id())
    per_part = placed.groupBy("p").agg(F.countDistinct("k").alias("keys")).collect()
    assert len(per_part) == 6 and all(r.keys == 1 for r in per_part)
    assert placed.count() == 500


def test_tied_counts_one_word_and_all_words(spark):
    counts = spark.createDataFrame([("x", 3), ("y", 3), ("z", 2), ("w", 1)], "word string, cnt bigint")
    one = sorted(map(tuple, top_n_distinct_counts(counts, 2).collect()))
    assert one == [(2, "z"), (3, "y")]
    allw = sorted(map(tuple, top_counts_all_keys(counts, 2).collect()))
    assert allw == [(2, 1, "z"), (3, 1, "x"), (3, 2, "y")]


def test_all_words_rows_and_joined_text(spark):
    from skein.session import fresh_dir
    from skein.sinks.files import write_joined_text

    counts = spark.range(0, 25).select(F.format_string("w%02d", "id").alias("word"), F.lit(1).cast("bigint").alias("cnt"))
    top = top_counts_all_keys(counts.repartition(5), 1)
    assert sorted((r.position, r.word) for r in top.collect()) == [(i + 1, f"w{i:02d}") for i in range(25)]
    path = fresh_dir(spark, "t-joined")
    write_joined_text(top, path, "word", ["position"], sep="|", by="cnt")
    import glob

    text = "".join(open(f).read() for f in sorted(glob.glob(f"{path}/cnt=1/part-*")))
    assert text == "".join(f"w{i:02d}|" for i in range(25))


def test_partition_per_key_refuses_more_keys_than_allowed(spark):
    df = spark.range(0, 40).select((F.col("id") % 20).cast("string").alias("k"), "id")
    with pytest.raises(ValueError):
        partition_per_key(df, "k", max_partitions=8)
    with pytest.raises(ValueError):
        top_n_per_group(df, "k", 1, ["id"], strategy="key_partitions", max_partitions=8)


def test_six_spellings_of_the_user_order_agree(spark):
    u = parse_users(rows(spark, USERS * 3)).distinct()
    want = [r.name for r in sort_by_rule(u, RULE).collect()]
    spellings = [
        u.orderBy(F.col("fv").desc(), F.col("age").asc()),
        u.orderBy((-F.col("fv")).asc(), "age"),
        u.orderBy(F.struct((-F.col("fv")).alias("a"), "age")),
        u.orderBy(["fv", "age"], ascending=[False, True]),
        top_n(u, 100, RULE),
        with_position(u, [*RULE, "name"]).orderBy("pos"),
    ]
    assert [[r.name for r in s.collect()] for s in spellings] == [want] * 6


def test_colocated_count_combines_before_its_shuffle(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("g"),
                                     (F.col("id") % 7).alias("t"))
    placed = count_by(df, ["g", "t"], partition_by="g")
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert sorted((r.g, r.t, r.cnt) for r in placed.collect()) == sorted(
        (r.g, r.t, r.cnt) for r in count_by(df, ["g", "t"]).collect())


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_positions_with_hot_ties_nulls_and_copies(spark, ranges):
    # A third of the rows share a key, half of those are alike in every column; some keys are null.
    df = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"),
        F.when(F.col("id") % 6 == 0, F.lit(0)).otherwise(F.col("id") % 11).alias("_skeinat")).repartition(5, "_skeinat")
    rule = [("key", "desc"), "_skeinat"]
    got = position_in_ranges(df, rule, "pos", ranges).orderBy("pos").collect()
    assert [r.pos for r in got] == list(range(1, 3001))
    want = [(r.key, r._skeinat) for r in sort_by_rule(df, rule).collect()]
    assert [(r.key, r._skeinat) for r in got] == want
    only_key = position_in_ranges(df, [("key", "asc")], "pos", ranges).orderBy("pos").collect()
    assert [r.key for r in only_key] == [r.key for r in sort_by_rule(df, ["key"]).collect()]
    assert sorted(r.pos for r in only_key) == list(range(1, 3001))


def test_positions_split_a_hot_tie_and_write_nothing(spark):
    df = spark.range(0, 20_000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("k"), "id")
    pos = position_in_ranges(df, ["k"], "pos", 12)
    plan = pos._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in plan.lower()
    # Two thirds of the rows are one tie, in several parts of their own.
    hot = pos.where("k = 5").agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first()
    below = df.where("k < 5").count()
    assert tuple(hot) == (below + 1, below + df.where("k = 5").count(), df.where("k = 5").count())


def test_positions_of_small_and_empty_tables(spark):
    one = spark.createDataFrame([("a", 1.5)], "k string, v double")
    assert [tuple(r) for r in position_in_ranges(one, ["k"]).collect()] == [("a", 1.5, 1)]
    assert position_in_ranges(one.where("false"), ["k"]).collect() == []
    odd = spark.createDataFrame([(float("nan"),), (None,), (-0.0,), (1e300,), (-5.0,)], "v double")
    got = position_in_ranges(odd, [("v", "desc")], "pos", 5).orderBy("pos").collect()
    assert [str(r.v) for r in got] == ["nan", "1e+300", "-0.0", "-5.0", "None"]
